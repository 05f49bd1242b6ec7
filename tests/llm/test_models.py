"""Embeddings, toxicity and the whole pipeline."""

import os
import random
import sys
import unicodedata
import zlib

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
from ledgerline.llm import byte_bpe, cover_tree, minhash, toxicity  # noqa: E402
from ledgerline.llm.common import table, texts  # noqa: E402

SF = "/root/testdata/sf0.01"


def test_cover_tree_pairs(spark, monkeypatch):
    monkeypatch.setattr(cover_tree, "CELL", 60)
    monkeypatch.setattr(cover_tree, "BLOCK", 40)
    r = np.random.default_rng(1)
    x = r.normal(size=(150, 12))
    near = [x[i % 7] * r.uniform(0.5, 3) + r.normal(size=12) * s for i, s in enumerate(np.tile([0.05, 0.2, 0.5, 0.9], 40))]
    rows = [v.astype(np.float32).tolist() for v in [*x, *near, x[0], x[0], x[1] * 2]]
    odd = [None, [], [0.0] * 12, [1.0, None] * 6, [float("nan")] * 12, [float("inf")] + [0.0] * 11, [1.0, 2.0], [1.0, 2.0, 0.0]]
    rows += odd
    full = np.zeros((len(rows), 12))
    good = np.zeros(len(rows), bool)
    for i, v in enumerate(rows):
        if v and all(c is not None and np.isfinite(c) for c in v) and any(v):
            full[i, :len(v)], good[i] = v, True
    norm = np.sqrt((full * full).sum(1))
    cosine = full @ full.T / np.maximum(np.outer(norm, norm), 1e-300)
    link = (cosine >= 0.9) & good[:, None] & good & ~np.eye(len(rows), dtype=bool)
    top = brute.joined(len(rows), list(zip(*np.nonzero(link))))
    df = spark.createDataFrame([(i, v, 0, "x") for i, v in enumerate(rows)],
                               "vec_id long, embedding array<float>, label int, cid string").repartition(3)
    got = {g.vec_id: (g.n_links, g.component_id, g.kept) for g in cover_tree.near_pairs(df).collect()}
    assert got == {i: (int(link[i].sum()), top[i], top[i] == i) for i in range(len(rows))}
    assert cover_tree.near_pairs(df.where("false")).count() == 0


def test_dual_keeps_the_last_node_pair():
    # 20 and 40 open pairs of 2,500 children each: exactly 50,000 and 100,000
    r = np.random.default_rng(3)
    for clusters in (20, 40):
        trees = []
        for _ in range(2):
            x = np.repeat(np.eye(48)[:clusters], 50, axis=0) + r.normal(size=(50 * clusters, 48)) * 0.03
            x /= np.sqrt((x * x).sum(1, keepdims=True))
            trees.append(cover_tree.Tree(x, np.repeat(np.arange(clusters) * 50, 50)[:, None], np.ones(len(x))))
        one, two = trees
        link = one.x @ two.x.T >= 0.96
        links1, links2, label = cover_tree.dual(one, two, 0.96, False)
        assert link[-50:, -50:].any() and not link[-50:, -50:].all()
        assert (links1 == link.sum(1)).all() and (links2 == link.sum(0)).all()
        assert label.tolist() == brute.joined(2 * len(one.x), [(a, b + len(one.x)) for a, b in zip(*np.nonzero(link))])


def test_automaton_finds_what_edit_distance_says():
    model = toxicity.Model([("moron", 5.0), ("worthless", 6.0), ("bad", 4.0), ("tête", 3.0)], [("lowei", 6.0)], frozenset())
    automaton = toxicity.Automaton(model)
    r = random.Random(4)
    words = ["moron", "moro", "mooron", "m0ron", "worthless", "w0rthles", "wrthles", "bad", "bod", "loweichen", "lowe", "lowaichen", "tete", "x"]
    for w in ["moron", "worthless", "tête"]:
        for _ in range(150):
            v = list(w)
            for _ in range(r.randint(0, 3)):
                k = r.randrange(len(v) + 1)
                v[k:k + r.randint(0, 1)] = r.choice(["", "z", "0", "o"])
            words.append("".join(v) or "q")
    code, starts, ends, owner = toxicity.tokens(words)
    found = {owner[k]: (e, d) for k, e, d in zip(*automaton.matches(code, starts, ends))}
    for i, w in enumerate(words):
        want = [(brute.edits(w, t), -x, k) for k, (t, x) in enumerate(model.terms)
                if brute.edits(w, t) <= (0 if len(t) < 4 else 1 if len(t) < 9 else 2)]
        want += [(0, -6.0, 4)] if w.startswith("lowei") else []
        assert (i in found) == bool(want), w
        if want:
            assert found[i] == (min(want)[2], min(want)[0]), w


def plain_strength(text, model):
    """The matches' sum of a text, by edit distance to every term and a plain look at the words around."""
    entries = [(t, w, False) for t, w in model.terms] + [(t, w, True) for t, w in model.stems]
    used, told, at, words = 0.0, 0.0, 0, []
    gap = lambda c: c.isspace() or c in ".,;:/\\()[]{}<>|=?" + toxicity.MARKS
    alnum = lambda c: c.isalnum() or unicodedata.category(c) == "Mn"
    while at < len(text):
        stop = at
        while stop < len(text) and not gap(text[stop]):
            stop += 1
        inside = [i for i in range(at, stop) if alnum(text[i])]
        if inside:
            words.append((inside[0], inside[-1] + 1))
        at = stop + 1
    for a, b in words:
        word = "".join(c.lower() if len(c.lower()) == 1 else c for c in text[a:b])
        found = []
        for k, (term, weight, stem) in enumerate(entries):
            allowed = 0 if stem or k in model.exact or len(term) < 4 else 1 if len(term) < 9 else 2
            e = 0 if stem and word.startswith(term) else brute.edits(word, term)
            if e <= allowed:
                found.append((e, -weight, k))
        if found:
            e, weight, _ = min(found)
            value = -weight * toxicity.EDITED[e]
            if toxicity.quoted(text, a, b):
                told = max(told, toxicity.QUOTED * value)
            else:
                used += value
    return used + told


def test_scores_are_those_of_a_plain_reading(spark):
    model = toxicity.Model([("moron", 5.0), ("worthless", 6.0), ("bad", 4.0), ("lowei", 2.5), ("\U0001d4d0head", 3.0), ("tête", 3.5),
                            ("scumbag", 4.5), ("idiot", 5.5)], [("lowei", 6.0), ("idio", 1.0)], frozenset([6]), -2.0, 5.0)
    r = random.Random(11)
    parts = ["moron", "m0ron", "Moron!", "worthles", "wrthles", "bad", "bade", "lowei", "lowie", "loweichen", "\U0001d4d0head", "\U0001d4d0hexd",
             "\U0001d4d1head", "tete", "scumbag", "scumbug", "idiotic", "idoit", "fine", "day,", '"', "“", "”", "he said", "the word", "\n", ".",
             "'", "x" * 60, "\U00010400moron", "\U0001f600"]
    texts = [" ".join(r.choice(parts) for _ in range(r.randint(0, 25))) for _ in range(200)] + ["", None]
    automaton = toxicity.Automaton(model)
    want = [plain_strength(t or "", model) for t in texts]
    assert np.allclose(toxicity.strengths([t or "" for t in texts], automaton), want) and max(want) > 10
    got = {x.doc_id: x.score for x in toxicity.score(brute.frame(spark, texts), model).collect()}
    logistic = [1 / (1 + np.exp(2.0 - 5.0 * w / (w + 4.0))) for w in want]
    assert all(abs(got[i] - p) < 1e-12 for i, p in enumerate(logistic))


def test_a_word_can_be_term_and_stem():
    model = toxicity.Model([("lowei", 6.0)], [("lowei", 5.0)], frozenset([0]))
    words = ["lowei", "loweichen", "lowe", "loweis"]
    code, starts, ends, owner = toxicity.tokens(words)
    assert {words[owner[k]] for k in toxicity.Automaton(model).matches(code, starts, ends)[0]} == {"lowei", "loweichen", "loweis"}


def test_states_are_forgotten_and_found_again(monkeypatch):
    monkeypatch.setattr(toxicity, "REMEMBERED", 3)
    automaton = toxicity.Automaton(toxicity.Model([("moron", 5.0), ("worthless", 6.0)], [], frozenset()))
    first = [toxicity.strengths(["you moron, wrthless", "morons and words"], automaton).tolist() for _ in range(3)]
    assert first[0] == first[1] == first[2] and first[0][0] > 0


def test_every_significant_word_is_learned(spark):
    """A thousand planted words, each in eight toxic documents, one of them very long: none is lost."""
    r = random.Random(12)
    planted = sorted({"".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9)) for _ in range(1000)} | {"long" * 13})
    usual = ["".join(r.choice("aeioumnrst") for _ in range(5)) for _ in range(300)]
    ids = [i for i in range(10_000) if zlib.crc32(str(i).encode()) % 5]
    rows = []
    for d in range(len(planted)):
        own = [planted[(8 * d + k) % len(planted)] for k in range(8)] + [r.choice(usual) for _ in range(12)]
        r.shuffle(own)  # no two documents share a passage
        rows.append((ids[d], " ".join(own), 1))
    for d in range(len(planted), 5 * len(planted)):
        rows.append((ids[d], " ".join(r.choice(usual) for _ in range(20)), 0))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(texts(df), df.select("doc_id", "toxic"))
    assert set(planted) <= {t for t, _ in model.terms}
    scored = toxicity.score(df, model).groupBy("predicted").count().collect()
    assert {x.predicted: x["count"] for x in scored} == {1: len(planted), 0: 4 * len(planted)}


def test_shortest_stems():
    found = {"abcd": 9, "abcde": 9, "abcdef": 4, "xyzw": 5, "xyzwv": 3, "xyz": 5, "q": 1}
    # abcd and xyz say no more than abcde and xyzw do; abcdef and xyzwv are held by those
    assert toxicity.shortest_stems(found) == ["q", "xyzw", "abcde"]


def test_quotation_is_told_from_abuse():
    say = lambda t, w: toxicity.quoted(t, t.index(w), t.index(w) + len(w))
    assert say('He wrote "you moron" to me.', "moron")
    assert say("The word moron is an insult.", "moron")
    assert not say("You are a moron.", "moron")
    assert not say('A "title" then moron', "moron")


def test_toxicity_held_out(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = toxicity.learn(texts(docs), labels)
    rows = toxicity.score(docs, model).join(labels, "doc_id").where(toxicity.held_out()).collect()
    right = sum(r.predicted == r.toxic for r in rows)
    assert len(rows) > 50 and right >= 0.95 * len(rows)
    odd = brute.frame(spark, [None, "", "idiot " * 20_000, "you IDIOT, scum", "idi0t and lo0ser", "fine words"], [1, None, 3, 3, 4, 5])
    got = [(r.doc_id, r.predicted) for r in toxicity.score(odd, model).collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (None, 0), (3, 1), (3, 1), (4, 1), (5, 0)], key=str)
    assert toxicity.score(odd.where("false"), model).count() == 0
    none = toxicity.learn(texts(docs), labels.where("false"))
    assert toxicity.score(docs, none).where("predicted = 1").count() == 0


def test_pipeline_stages(spark):
    import corpus_pipeline as p
    sf = "/root/testdata/sf0.001"
    docs = table(spark, sf, "documents")
    seen = {}
    for name, stage in p.STAGES:
        out = p.stored(stage(spark, docs, sf), name)
        if name != p.STAGES[-1][0]:
            assert out.dtypes == docs.dtypes
        seen[name], docs = (docs, out), out
    before, after = (x.select("doc_id", "text").collect() for x in seen["near_duplicates"])
    _, top = brute.near_groups([r.text for r in before], 5)
    low = {}
    for r, c in zip(before, top):
        low[c] = min(low.get(c, r.doc_id), r.doc_id)
    assert {r.doc_id for r in after} == set(low.values())
    before, after = (x.orderBy("doc_id").collect() for x in seen["repeated_passages"])
    want = brute.without_repeats([r.text.encode() for r in before])
    assert all(r.text == w[3].decode("utf-8", "replace") for r, w in zip(after, want))
    before, after = seen["benchmark_leaks"]
    items = [r.text for r in table(spark, sf, "benchmark").collect()]
    rows = before.collect()
    bad = {rows[d].doc_id for d, _ in brute.contained([r.text for r in rows], items)}
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in rows} - bad
    before, after = seen["tokens"]
    own = {r.doc_id: r.text for r in before.collect()}
    table_ = byte_bpe.token_bytes(p.public_tokenizers.path("byte_bpe_50k.tiktoken"))
    got = after.collect()
    assert len(got) == len(own) and all(b"".join(table_[i] for i in r.ids) == own[r.doc_id].encode() for r in got)
    assert minhash.BANDS * minhash.ROWS % minhash.PER_LONG == 0
