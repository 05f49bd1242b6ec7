"""Plain reference versions of the operators, for small fixtures."""

import collections
import random

from ledgerline.llm.words import shingle_set

LONG = "doc_id long, text string, source string, __id string, text_key string, first string, cid string, spans string, ids string"


def frame(spark, texts, ids=None):
    """A documents table with extra columns whose names clash with internal ones."""
    ids = ids if ids is not None else range(len(texts))
    rows = [(i, t, "src", "x", "y", "z", "c", "s", "i") for i, t in zip(ids, texts)]
    return spark.createDataFrame(rows, LONG).repartition(3)


def prose(seed=1, n=30, longest=120):
    r = random.Random(seed)
    word = lambda: r.choice(["tion", "eine", "ñ", "the", "and", "ou", "la", "x"]) + r.choice("abcdefg")
    say = lambda k: " ".join(word() for _ in range(k))
    base = [say(r.randint(0, longest)) for _ in range(n)]
    shared = say(60)
    out = base + [None, "", " \t\n", "a" * 199, "a" * 200, "a" * 900, "ab" * 300, base[3], base[3], "A b", "a  B"]
    for _ in range(n):
        words = r.choice(base).split()
        for _ in range(r.randint(0, 4)):
            words.insert(r.randint(0, len(words)), word())
        out.append(" ".join(words))
    return out + [say(r.randint(0, 30)) + shared + say(r.randint(0, 30)) for _ in range(12)]


def without_repeats(texts, width=200):
    seen = collections.Counter(t[i:i + width] for t in texts for i in range(len(t) - width + 1))
    out = []
    for t in texts:
        cut = bytearray(len(t))
        for i in range(len(t) - width + 1):
            if seen[t[i:i + width]] > 1:
                cut[i:i + width] = b"\1" * width
        spans = sum(1 for i in range(len(t)) if cut[i] and (i == 0 or not cut[i - 1]))
        out.append((len(t), sum(cut), spans, bytes(c for c, x in zip(t, cut) if not x)))
    return out


def joined(n, links):
    label = list(range(n))

    def top(x):
        while label[x] != x:
            x = label[x]
        return x
    for a, b in links:
        a, b = top(a), top(b)
        label[max(a, b)] = min(a, b)
    return [top(i) for i in range(n)]


def near_groups(texts, n, percent=80):
    sets = [shingle_set((t or "").encode(), n) for t in texts]
    links = [(i, j) for i in range(len(sets)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    return [len(s) for s in sets], joined(len(sets), links)


def contained(texts, items, n=5, percent=80):
    out = set()
    for d, t in enumerate(texts):
        for k, item in enumerate(items):
            want = shingle_set((item or "").encode(), n)
            if want:
                width = len(next(iter(want)))
                have = shingle_set((t or "").encode(), width)
                if 100 * len(want & have) >= percent * len(want):
                    out.add((d, k))
    return out


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]
