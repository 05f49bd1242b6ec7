"""Toxicity scores from a learned lexicon, matched in spite of misspellings and read in context.

Learning takes a bounded sample of labelled documents. Words and word stems that
occur in toxic documents far more often than chance allows form a lexicon with weights
(log odds). It is laid out as a trie, and the Levenshtein automata of all its terms are
intersected with it: a state is a set of (trie node, edits so far). A table reads all words of a
column side by side, one character a step; its states are worked out when a text first needs them, so that
the table follows the words that are met and not the size of the lexicon. Terms of four characters and more may have one edit, of nine and more two;
stems are matched exactly and may be continued.

A match counts in full, with an edit for less, and hardly at all if its window of characters shows
quotation (quotation marks around it, or a word of saying or naming before it): talking about a
word is not abuse. A logistic function of the matches' sum, also learned, gives the score.
Labels, language, source and id are inputs of no score.
"""

from __future__ import annotations

import bisect
import collections
import functools
import math
import re
import unicodedata
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, flat, lists, own_prefix, slices, stored, texts
from ledgerline.llm.words import mix, shingles, span_hashes, word_spans

#: Labelled documents that are learned from (about; chosen by a hash of the id). All else follows from them: every
#: entry that is significant in them is kept.
SAMPLE = 20_000
#: States that a worker remembers at most; then it starts anew.
REMEMBERED = 100_000
#: What a match with one or two edits and a quoted match count, and the characters looked at on either side.
EDITED, QUOTED, WINDOW = (1.0, 0.7, 0.5), 0.12, 48
#: Minima that tell near copies in the sample.
COPY_MINIMA = 8
#: Expected number of lexicon entries that owe their place to chance.
CHANCE = 0.05
_MAX_WEIGHT = 6.0

# Words of saying or naming before a quoted term, and quotation marks.
SAYING = re.compile(r"\b(?:said|says|wrote|writes|called|calls|quoted?|quoting|the (?:word|term|slur|insult)|"
                    r"sagte|schrieb|nannte|das wort|dit|a dit|appelé|le mot|dijo|llamó|la palabra)\b[^.!?\n]*$", re.I)
MARKS = "\"“”„«»‹›"


@dataclass
class Model:
    terms: list[tuple[str, float]] = field(default_factory=list)
    stems: list[tuple[str, float]] = field(default_factory=list)
    #: Entries whose misspellings are usual words: they are matched exactly only.
    exact: frozenset = frozenset()
    bias: float = -3.0
    slope: float = 8.0


# ------------------------------------------------------------------ characters and words

_DIVIDERS = frozenset(".,;:/\\()[]{}<>|=?" + MARKS)


def _character(c: int) -> tuple[int, bool, bool]:
    """Lower case of a code point, whether it is white space or a divider, and whether it is a letter, digit or mark."""
    s = chr(c)
    if 0xD800 <= c < 0xE000:
        return c, False, False
    low = s.lower()
    return (ord(low) if len(low) == 1 else c), s.isspace() or s in _DIVIDERS, s.isalnum() or unicodedata.category(s) == "Mn"


@functools.lru_cache(maxsize=1)
def _characters() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`_character` of all code points of the basic plane."""
    low, gap, alnum = zip(*map(_character, range(65536)))
    return np.array(low, np.uint32), np.array(gap), np.array(alnum)


def _classified(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """:func:`_character` of many code points; those beyond the basic plane are looked up one by one."""
    low, gap, alnum = _characters()
    if not (code >= 65536).any():
        return low[code], gap[code], alnum[code]
    far, at = np.unique(code, return_inverse=True)
    own = [_character(int(c)) for c in far]
    return tuple(np.array(x, t)[at] for x, t in zip(zip(*own), (np.uint32, bool, bool)))


def tokens(strings: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(lower-case code points of all strings, starts, ends, string number) of their words.

    A word runs from a letter or digit to the last one before white space or a dividing mark, and
    may hold other marks inside.
    """
    code, gaps, alnum = _classified(np.frombuffer("".join(strings).encode("utf-32-le", "replace"), np.uint32))
    first = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    part = np.cumsum(gaps)
    edge = np.zeros(len(code) + 1, np.int64)
    np.add.at(edge, first[:-1], 1)
    part = part + np.cumsum(edge)[:-1]
    at = np.flatnonzero(alnum & ~gaps)
    new = np.ones(len(at), bool)
    new[1:] = part[at[1:]] != part[at[:-1]]
    starts = at[new]
    ends = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)] + 1 if len(at) else at
    return code, starts, ends, np.searchsorted(first, starts, "right") - 1


# ------------------------------------------------------------------ automata and trie

class Automaton:
    """The intersection of the lexicon trie with the Levenshtein automata of its terms, made deterministic on demand."""

    def __init__(self, model: Model):
        self.weights = [w for _, w in model.terms] + [w for _, w in model.stems]
        self.children: list[dict[str, int]] = [{}]
        #: For each node the entries that end there: (entry, edits allowed, may be continued).
        self.ends: list[list[tuple[int, int, bool]]] = [[]]
        self.reach: list[int] = [0]  # most edits that any entry below allows
        for i, (term, stem) in enumerate([(t, False) for t, _ in model.terms] + [(t, True) for t, _ in model.stems]):
            allowed = 0 if stem or i in model.exact or len(term) < 4 else 1 if len(term) < 9 else 2
            node = 0
            self.reach[0] = max(self.reach[0], allowed)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.reach.append(0)
                node = self.children[node][c]
                self.reach[node] = max(self.reach[node], allowed)
            self.ends[node].append((i, allowed, stem))
        self.letters = sorted({c for kids in self.children for c in kids})
        self._forget()

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("classes", "states", "index", "other", "table", "final")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self._forget()

    def _forget(self) -> None:
        """No state but the empty one (0) and the start (1)."""
        self.classes = np.zeros(0x110000, np.int32)  # 0: a character that no entry has
        self.classes[[ord(c) for c in self.letters]] = np.arange(1, len(self.letters) + 1)
        self.states, self.index, self.other = [], {}, []
        self.table = np.full((1024, len(self.letters) + 1), -1, np.int32)
        self.final = np.full((1024, 2), -1, np.int64)
        self._number(frozenset())
        self.table[0] = 0
        self._number(self._closed([(0, 0)]))

    def _number(self, state: frozenset) -> int:
        at = self.index.setdefault(state, len(self.states))
        if at == len(self.states):
            self.states.append(state)
            self.other.append(-1)
            if at == len(self.table):
                self.table = np.concatenate([self.table, np.full_like(self.table, -1)])
                self.final = np.concatenate([self.final, np.full_like(self.final, -1)])
            self.final[at] = self._verdict(state)
        return at

    def _closed(self, pairs) -> frozenset:
        """Also skip letters of the lexicon; keep the fewest edits for each node."""
        best, todo = {}, collections.deque(sorted(pairs, key=lambda p: p[1]))
        while todo:
            node, e = todo.popleft()
            if best.get(node, 9) <= e or node >= 0 and e > self.reach[node]:
                continue
            best[node] = e
            if node >= 0:
                todo += [(kid, e + 1) for kid in self.children[node].values() if e < self.reach[kid]]
        return frozenset(best.items())

    def _step(self, state: frozenset, c: str | None) -> frozenset:
        out = []
        for node, e in state:
            if node < 0:  # inside the rest of a matched stem
                out.append((node, e))
                continue
            for letter, kid in self.children[node].items():
                if letter == c:
                    out.append((kid, e))
                elif e < self.reach[kid]:
                    out.append((kid, e + 1))
            if e < self.reach[node]:
                out.append((node, e + 1))
            out += [(-1 - entry, e) for entry, allowed, stem in self.ends[node] if stem and e <= allowed]
        return self._closed(out)

    def _verdict(self, state: frozenset) -> tuple[int, int]:
        """(entry, edits) of the best match if the word ends here."""
        found = [(e, -self.weights[-1 - n], -1 - n) for n, e in state if n < 0]
        found += [(e, -self.weights[entry], entry) for n, e in state if n >= 0
                  for entry, allowed, _ in self.ends[n] if e <= allowed]
        return (min(found)[2], min(found)[0]) if found else (-1, 0)

    def _target(self, at: int, letter: int) -> int:
        """The state after ``letter``; all letters that no node of the state goes on with lead to the same one."""
        state, c = self.states[at], self.letters[letter - 1] if letter else None
        if c is not None and any(n >= 0 and c in self.children[n] for n, _ in state):
            return self._number(self._step(state, c))
        if self.other[at] < 0:
            self.other[at] = self._number(self._step(state, None))
        return self.other[at]

    def _next(self, state: np.ndarray, letter: np.ndarray) -> np.ndarray:
        out = self.table[state, letter]
        new = np.flatnonzero(out < 0)
        if len(new):
            width = len(self.letters) + 1
            for code in np.unique(state[new] * width + letter[new]).tolist():
                target = self._target(*divmod(code, width))
                self.table[divmod(code, width)] = target  # after the target may have enlarged the table
            out = self.table[state, letter]
        return out

    def matches(self, code: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word number, entry, edits) of the words that are in the lexicon or close to it."""
        if len(self.states) > REMEMBERED:
            self._forget()
        letter = self.classes[code]
        alive, state, at = np.arange(len(starts)), np.ones(len(starts), np.int64), starts.copy()
        out = [(np.zeros(0, np.int64), np.zeros((0, 2), np.int64))]
        while len(alive):
            state = self._next(state, letter[at]).astype(np.int64)
            at = at + 1
            over = at >= ends[alive]
            if over.any():
                verdicts = self.final[state[over]]
                hit = verdicts[:, 0] >= 0
                out.append((alive[over][hit], verdicts[hit]))
            go = (state > 0) & ~over
            alive, state, at = alive[go], state[go], at[go]
        words, verdicts = (np.concatenate(z) for z in zip(*out))
        return words, verdicts[:, 0], verdicts[:, 1]


def quoted(text: str, start: int, end: int) -> bool:
    """Whether the window around ``text[start:end]`` shows that the word is quoted, not used."""
    before = text[max(0, start - WINDOW):start].rpartition("\n")[2]
    after = text[end:end + WINDOW].partition("\n")[0]
    marks = sum(before.count(m) for m in MARKS)
    single = before.endswith("'") and after.startswith("'")
    return single or (marks % 2 == 1 and any(m in after for m in MARKS)) or bool(SAYING.search(before))


def strengths(strings: list[str], automaton: Automaton) -> np.ndarray:
    """The matches' sum of each text: all that are used, and the strongest of those quoted."""
    code, starts, ends, owner = tokens(strings)
    words, entries, edits = automaton.matches(code, starts, ends)
    used, told = np.zeros(len(strings)), np.zeros(len(strings))
    first = np.concatenate([[0], np.cumsum([len(s) for s in strings])])
    for w, entry, e in zip(words.tolist(), entries.tolist(), edits.tolist()):
        d = owner[w]
        value = automaton.weights[entry] * EDITED[e]
        if quoted(strings[d], int(starts[w] - first[d]), int(ends[w] - first[d])):
            told[d] = max(told[d], QUOTED * value)
        else:
            used[d] += value
    return used + told


def _strings(batch: pa.RecordBatch, column: int):
    """(first row, texts) of bounded pieces of a binary column."""
    data, offsets = flat(batch.column(column))
    for i, j in slices(offsets):
        raw = data[offsets[i]:offsets[j]].tobytes()
        at = offsets[i:j + 1] - offsets[i]
        yield i, [raw[a:b].decode("utf-8", "replace") for a, b in zip(at[:-1], at[1:])]


# ------------------------------------------------------------------ learning

def held_out(id_col: str = "doc_id"):
    """True for the fifth of the ids that is never learned from (null: false)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, toxic, minima) of about SAMPLE labelled documents; minima of hashes of their word shingles."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")) \
        .where("doc_id is not null and toxic is not null").where(~held_out())
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    n = max(1, known.count())
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, SAMPLE / n))
    chosen = stored(known.where(share), "toxic-labels")  # about SAMPLE rows of two numbers

    def run(batches):
        for batch in batches:
            data, offsets = flat(batch.column(1))
            for i, j in slices(offsets):
                own = data[offsets[i]:offsets[j]]
                starts, _, words = word_spans(own, offsets[i:j + 1] - offsets[i])
                hashes, at = shingles(span_hashes(own, starts), words, 5)
                lows = np.zeros((j - i, COPY_MINIMA), np.int64)
                full = np.flatnonzero(np.diff(at))
                for k in range(COPY_MINIMA if len(full) else 0):
                    lows[full, k] = np.minimum.reduceat(mix(hashes + np.uint64(k + 1)), at[full]).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(i, j - i).columns, lists(pa.array(lows.ravel()), np.arange(j - i + 1) * COPY_MINIMA)],
                    names=["doc_id", "text", "toxic", "minima"])

    joined = docs.join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    return stored(arrow_map(joined, run, "doc_id long, text binary, toxic int, minima array<long>"), "toxic-sample")


def _without_copies(sample: DataFrame) -> DataFrame:
    """Of near copies nearly all go: a document stays if it is the first of all that share any of its minima."""
    groups = sample.select("doc_id", F.posexplode("minima").alias("k", "low"))
    first = groups.groupBy("k", "low").agg(F.min("doc_id").alias("doc_id"))
    alone = first.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") == COPY_MINIMA)
    return sample.join(alone, "doc_id", "left_semi")


def _log_chance(toxic: float, clean: float, base: float) -> float:
    """log P(at least ``toxic`` of toxic + clean documents are toxic) at the base rate (its first and largest term)."""
    n = toxic + clean
    return (math.lgamma(n + 1) - math.lgamma(toxic + 1) - math.lgamma(clean + 1)
            + toxic * math.log(base) + clean * math.log1p(-base))


def _lexicon(sample: DataFrame) -> Model:
    own = _without_copies(sample).select("text", "toxic")
    totals = {r.toxic: r["count"] for r in own.groupBy("toxic").count().collect()}
    n1, n0 = totals.get(1, 0), totals.get(0, 0)
    if not n1 or not n0:
        return Model()
    base = n1 / (n1 + n0)

    def run(batches):
        for batch in batches:
            toxic = batch.column(1).to_pylist()
            for i, strings in _strings(batch, 0):
                code, starts, ends, owner = tokens(strings)
                text = code.astype(np.uint32).tobytes().decode("utf-32-le", "replace")
                counts: dict[str, list[int]] = {}
                for d, w in {(d, text[a:b]) for d, a, b in zip(owner.tolist(), starts.tolist(), ends.tolist())}:
                    counts.setdefault(w, [0, 0])[toxic[i + d]] += 1
                yield pa.RecordBatch.from_pydict({
                    "word": list(counts), "clean": pa.array([c for c, _ in counts.values()], pa.int64()),
                    "toxic": pa.array([t for _, t in counts.values()], pa.int64())})

    words = stored(arrow_map(own, run, "word string, clean long, toxic long").groupBy("word").agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")), "toxic-words")
    odds = F.log(((F.col("toxic") + 0.5) / (n1 + 1)) / ((F.col("clean") + 0.5) / (n0 + 1)))
    letters = F.col("word").rlike(r"^[\p{L}\p{M}]{3,}$")

    def candidates(table: DataFrame):
        """Entries that are more frequent in toxic documents than chance allows among all that were tested.

        All come from the sample, which bounds their number.
        """
        tested = table.where("toxic + clean >= 3").count()
        rows = table.withColumn("odds", odds).where("toxic >= 3").where(F.col("odds") > math.log(8)) \
            .orderBy(F.desc(F.col("toxic") * F.col("odds")), "word").collect()
        bound = math.log(CHANCE / max(1, tested))
        return [r for r in rows if _log_chance(r.toxic, r.clean, base) < bound]

    def weight(r):
        return min(_MAX_WEIGHT, r.odds)

    terms = [(r.word, weight(r)) for r in candidates(words.where(letters))]
    prefixes = words.where(letters).where(F.length("word") > 4).select(
        F.explode(F.transform(F.sequence(F.lit(4), F.least(F.length("word") - 1, F.lit(9))),
                              lambda k: F.substring("word", F.lit(1), k))).alias("stem"), "clean", "toxic")
    grouped = prefixes.groupBy(F.col("stem").alias("word")).agg(
        F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("kinds"))
    found = {r.word: r for r in candidates(grouped.where("kinds >= 3"))}
    return Model(terms, [(w, weight(found[w])) for w in shortest_stems({w: r.toxic for w, r in found.items()})])


def shortest_stems(found: dict[str, int]) -> list[str]:
    """Of stems with their numbers of toxic documents those that say most: not one whose longer stem says the
    same, and none that a shorter one holds. Shorter ones first."""
    ordered, stems = sorted(found), set()
    for word in sorted(found, key=lambda w: (len(w), w)):
        longer = ordered[bisect.bisect_right(ordered, word):bisect.bisect_left(ordered, word + chr(0x10FFFF))]
        if any(found[w] == found[word] for w in longer) or any(word[:k] in stems for k in range(1, len(word))):
            continue
        stems.add(word)
    return sorted(stems, key=lambda w: (len(w), w))


def _unreliable(sample: DataFrame, model: Model) -> frozenset:
    """Entries whose misspellings occur in clean documents: close to a usual word."""
    shared = sample.sparkSession.sparkContext.broadcast(Automaton(model))

    def run(batches):
        for batch in batches:
            for _, strings in _strings(batch, 0):
                code, starts, ends, _ = tokens(strings)
                _, entries, edits = shared.value.matches(code, starts, ends)
                yield pa.RecordBatch.from_pydict({"entry": pa.array(entries[edits > 0], pa.int64())})

    clean = arrow_map(sample.where("toxic = 0").select("text"), run, "entry long")
    return frozenset(r.entry for r in clean.distinct().collect())  # at most one a lexicon entry


def _fit(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Bias and slope of a logistic regression on one feature, with a small penalty (Newton's method, halved steps)."""
    design, beta, penalty = np.column_stack([np.ones_like(x), x]), np.zeros(2), 1e-2

    def loss(b):
        z = design @ b
        return np.logaddexp(0, z).sum() - y @ z + penalty / 2 * b @ b

    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        grad = design.T @ (y - p) - penalty * beta
        step = np.linalg.solve((design * (p * (1 - p))[:, None]).T @ design + penalty * np.eye(2), grad)
        while np.abs(step).max() > 1e-9 and loss(beta + step) > loss(beta):
            step = step / 2
        beta = beta + step
        if np.abs(step).max() < 1e-6:
            break
    return float(beta[0]), float(beta[1])


def _feature(strength: np.ndarray) -> np.ndarray:
    return strength / (strength + 4.0)


def learn(docs: DataFrame, labels: DataFrame) -> Model:
    """The model from the labelled rows of ``docs`` (doc_id, text as bytes) outside the held-out fifth.

    Labels that are null, or of ids without document, teach nothing; a repeated id is toxic if one of its labels
    is. Without labels of both kinds the lexicon is empty and every score is low.
    """
    sample = _sample(docs, labels)
    model = _lexicon(sample)
    if not model.terms and not model.stems:
        return model
    model.exact = _unreliable(sample, model)
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(model))

    def run(batches):
        for batch in batches:
            for i, strings in _strings(batch, 0):
                yield pa.RecordBatch.from_arrays([pa.array(strengths(strings, shared.value)),
                                                  batch.column(1).slice(i, len(strings))], names=["x", "toxic"])

    rows = arrow_map(sample.select("text", "toxic"), run, "x double, toxic int").toArrow()  # about SAMPLE pairs
    model.bias, model.slope = _fit(_feature(rows["x"].to_numpy()), rows["toxic"].to_numpy().astype(float))
    return model


# ------------------------------------------------------------------ scoring

def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text_key, score, predicted) of every row of ``docs``.

    Null and empty texts are scored as texts without a match; repeated rows get equal scores; null ids stay
    null. Other columns are not read; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(model))
    bias, slope = model.bias, model.slope

    def run(batches):
        for batch in batches:
            for i, strings in _strings(batch, 1):
                z = bias + slope * _feature(strengths(strings, shared.value))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, len(strings)), batch.column(2).slice(i, len(strings)),
                     pa.array(1 / (1 + np.exp(-np.clip(z, -500, 500))))], names=["doc_id", "text_key", "score"])

    keyed = texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
    out = arrow_map(keyed, run, "doc_id long, text_key long, score double")
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows scored as toxic; rows and columns are otherwise unchanged.

    Null and empty texts match nothing and stay; repeated rows stay or go together; an empty table gives an empty one.
    """
    model = learn(texts(docs), labels)
    shared = docs.sparkSession.sparkContext.broadcast(Automaton(model))
    bias, slope = model.bias, model.slope
    schema, n = docs.schema, len(docs.columns)

    def run(batches):
        for batch in batches:
            for i, strings in _strings(batch, n):
                keep = bias + slope * _feature(strengths(strings, shared.value)) < 0
                part = pa.RecordBatch.from_arrays(batch.columns[:n], names=schema.names).slice(i, len(strings))
                yield part.filter(pa.array(keep))

    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    return arrow_map(docs.withColumn(f"{own_prefix(docs)}text", body), run, schema)
