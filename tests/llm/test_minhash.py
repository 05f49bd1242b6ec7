"""Near-duplicate groups: crowded buckets, recall near the threshold, odd rows."""

import os
import random
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(__file__))

import brute  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from ledgerline.llm import minhash  # noqa: E402
from ledgerline.llm.words import shingle_set  # noqa: E402


def say(r, k):
    return [f"w{r.randrange(10**6)}" for _ in range(k)]


def similarity(a, b, n):
    one, two = (shingle_set(t.encode(), n) for t in (a, b))
    return len(one & two) / len(one | two)


def changed(r, words, count, n):
    """``words`` with ``count`` words replaced, no two of them in one shingle."""
    out, at = list(words), r.sample(range(n, len(words) - n, n), count)
    for i in at:
        out[i] = f"x{r.randrange(10**9)}"
    return " ".join(out)


def test_crowded_buckets_make_rows_in_proportion(spark, monkeypatch):
    """Members that share one band with thousands of others of different components."""
    made = []

    def counted(fn):
        def run(*args):
            out = fn(*args)
            made.extend(x.count() for x in (out if isinstance(out, tuple) else (out,)))
            return out
        return run
    for name in ("_members", "_cut_up"):
        monkeypatch.setattr(minhash, name, counted(getattr(minhash, name)))
    totals = []
    for n in (2560, 5120, 10240):
        made.clear()
        bands = np.random.default_rng(n).integers(1, 1 << 60, (n, minhash.BANDS))
        bands[:, 3] = 7
        own = spark.createDataFrame([(i, b.tolist()) for i, b in enumerate(bands)], "cid long, bands array<long>")
        reps = own.select("cid", F.lit(100).cast("long").alias("n_shingles"), "bands", *[
            F.array_repeat(F.lit(0).cast("long"), k).alias(c)
            for c, k in (("sig", minhash.SIGNATURE_LONGS), ("parity", minhash.PARITY_BITS // 64))])
        rooted = reps.select("cid", F.col("cid").alias("root"), F.posexplode("bands").alias("number", "band")).where("number = 3")
        assert minhash._across(rooted, reps, 80).count() == 0  # no two are alike
        totals.append(sum(made))
    assert totals[0] >= 2560 and totals[1] <= 2.05 * totals[0] and totals[2] <= 2.05 * totals[1]


def test_a_few_outside_the_largest_component_are_copied(spark):
    """Of a bucket only the members outside its largest component go to every piece."""
    n = 4096
    zero = {c: F.array_repeat(F.lit(0).cast("long"), k) for c, k in (
        ("bands", minhash.BANDS), ("sig", minhash.SIGNATURE_LONGS), ("parity", minhash.PARITY_BITS // 64))}
    reps = spark.range(n).select(F.col("id").alias("cid"), F.lit(100).cast("long").alias("n_shingles"),
                                 *[v.alias(k) for k, v in zero.items()])
    level = reps.select("cid", F.when(F.col("cid") < 10, F.col("cid")).otherwise(99).alias("root"), F.lit(0).alias("number"),
                        F.lit(5).cast("long").alias("key"), F.array(F.lit(0).cast("long")).alias("path"))
    keys = minhash._open_keys(level)
    assert [tuple(r) for r in keys.collect()] == [(5, n, 99, 10)]
    few, all_ = minhash._members(level.join(keys, "key"), reps)
    assert (few.count(), all_.count()) == (10 * n // minhash.WIDE, n)


def test_recall_at_the_threshold(spark):
    r = random.Random(8)
    texts, pairs = [], []
    for _ in range(400):  # 0.80 to 0.85
        words = say(r, 400)
        texts += [" ".join(words), changed(r, words, r.choice((7, 8)), 5)]
        pairs.append((len(texts) - 2, len(texts) - 1))
    for _ in range(100):  # exactly 0.80: 8 of 10 shingles
        words = say(r, 13)
        texts += [" ".join(words), " ".join([*words[:-1], "other"])]
        pairs.append((len(texts) - 2, len(texts) - 1))
    for _ in range(100):  # just below: 7 of 11
        words = say(r, 13)
        texts += [" ".join(words), " ".join([*words[:-2], "other", words[-1]])]
    near = [similarity(texts[a], texts[b], 5) for a, b in pairs]
    assert all(0.8 <= s <= 0.86 for s in near) and near[-100:] == [0.8] * 100
    got = {x.doc_id: x.component_id for x in minhash.groups(brute.frame(spark, texts)).collect()}
    found = sum(got[a] == got[b] == a for a, b in pairs)
    print(f"recall between 0.80 and 0.85: {found / len(pairs)}")
    assert found >= 0.99 * len(pairs)
    assert all(got[i] == i for i in range(2 * len(pairs), len(texts)))


def test_crowds_of_unlike_documents_with_a_common_part(spark, monkeypatch):
    """Half of every text is the same: all meet in the same buckets, and only planted pairs are linked."""
    for name, value in (("FEW", 6), ("WIDE", 16), ("PIECE", 4)):
        monkeypatch.setattr(minhash, name, value)
    cut = []
    real = minhash._cut_up
    monkeypatch.setattr(minhash, "_cut_up", lambda *a: cut.append(1) or real(*a))
    r = random.Random(9)
    common = say(r, 120)
    texts = []
    for _ in range(60):
        words = common + say(r, 80)
        texts += [" ".join(words), changed(r, words, r.choice((2, 3, 4, 5, 6)), 5), " ".join(common + say(r, 80))]
    sizes, top = brute.near_groups(texts, 5)
    got = {x.doc_id: (x.n_shingles, x.component_id) for x in minhash.groups(brute.frame(spark, texts)).collect()}
    assert cut and got == {i: (sizes[i], top[i]) for i in range(len(texts))}


def test_repeated_rows_and_null_ids(spark):
    r = random.Random(10)
    a, b = " ".join(say(r, 300)), " ".join(say(r, 300))
    texts = [a, a, a, b, None, "", None, b + " end", a, "long " * 200_000, "long " * 200_000]
    ids = [4, 4, None, None, 7, 7, None, None, 9, 11, 12]
    rows = minhash.groups(brute.frame(spark, texts, ids)).collect()
    got = sorted(((x.doc_id, x.n_shingles, x.component_id, x.kept) for x in rows), key=repr)
    want = [(4, 296, 4, True), (4, 296, 4, True), (None, 296, 4, False), (9, 296, 4, False), (None, 296, None, True),
            (None, 297, None, True), (7, 0, 7, True), (7, 0, 7, True), (None, 0, None, True), (11, 1, 11, True), (12, 1, 11, False)]
    assert got == sorted(want, key=repr)
    kept = minhash.keep_one(brute.frame(spark, texts, ids))
    assert sorted((x.doc_id or 0 for x in kept.collect())) == [0, 0, 0, 4, 4, 7, 7, 11]


def test_pairs_that_share_only_one_crowded_bucket(spark, monkeypatch):
    """All texts share the last band and no other: cutting it up by later bands leaves nothing, yet no link is lost."""
    for name, value in (("FEW", 6), ("WIDE", 16), ("PIECE", 2)):
        monkeypatch.setattr(minhash, name, value)
    r = random.Random(11)
    common, texts = say(r, 40), []
    for _ in range(40):
        words = say(r, 200) + common
        texts += [" ".join(words), changed(r, words, r.choice((1, 3, 5)), 5)]
    docs = minhash.texts(brute.frame(spark, texts)).withColumn("text_key", F.xxhash64("text"))
    own = F.transform(F.sequence(F.lit(1), F.lit(minhash.BANDS - 1)), lambda k: F.xxhash64(k, "doc_id"))
    reps = minhash.stored(minhash.signatures(docs, 5).withColumn("cid", F.col("doc_id")).withColumn(
        "bands", F.concat(own, F.array(F.lit(7).cast("long")))), "test-signatures")
    links = {(x.b, x.a) for x in minhash._links(reps, docs, 5, 80).collect()}
    assert links == {(i, i + 1) for i in range(0, len(texts), 2)}
