"""Search, hard negatives and whitening of embeddings against plain versions."""

import math
import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(__file__))

from pyspark.sql import functions as F  # noqa: E402

from ledgerline.llm import hard_negatives, inner_products, vectors, whitening  # noqa: E402

SCHEMA = ("vec_id long, embedding array<float>, label int, rid string, x string, score string, block string, length string,"
          " bits string, g string, n string")
ODD = [None, [None] * 6, [1.0, None] * 3, [math.nan] * 6, [math.inf] + [0.0] * 5, [-math.inf] * 6]


def table(spark, seed=1, n=120, dim=6):
    """Vectors with ties, repeated rows and ids, null ids and labels, a common vector, short and unusable vectors."""
    r = np.random.default_rng(seed)
    rows = [(i, (r.normal(size=dim) * r.choice([0.1, 0.3, 1.0])).astype(np.float32).tolist(), int(r.integers(0, 4)))
            for i in range(n)]
    common = rows[5][1]
    rows += [(n + i, common, int(r.integers(0, 4))) for i in range(n // 2)]
    rows += [rows[0], rows[0], rows[20], (20, rows[3][1], 2), (None, rows[40][1], 1), (None, rows[40][1], 1)]
    rows += [(1000, [0.0] * dim, 1), (1100, [], 1), (1200, [1.5, -0.25], 2), (1300, rows[7][1], None), (-100, rows[8][1], 3),
             (1400, [-v for v in rows[60][1]], 9), (1407, rows[9][1], -1)]
    rows += [(2000 + i, v, 1) for i, v in enumerate(ODD)]
    return rows, spark.createDataFrame([(*v, *"abcdefgh") for v in rows], SCHEMA).repartition(3)


def good(rows, scale, dim=6):
    """(id, label, whole numbers) of the usable rows."""
    out = []
    for i, v, label in rows:
        if v is not None and all(c is not None and math.isfinite(c) for c in v):
            out.append((i, label, [math.floor(scale * c) for c in v] + [0] * (dim - len(v))))
    return out


def first(found, k):
    return sorted(found, key=lambda p: (-p[0], p[1] is None, p[1] or 0))[:k]


def plain_top(rows, every, k):
    x, out = good(rows, 64), []
    for a, (i, _, v) in enumerate(x):
        if i is not None and i % every == 0:
            found = [(sum(p * q for p, q in zip(v, w)), j) for b, (j, _, w) in enumerate(x) if a != b]
            out += [(i, rank, j, s) for rank, (s, j) in enumerate(first(found, k), 1)]
    return sorted(out, key=repr)


def java_mod(a, b):
    return int(math.fmod(a, b))


def plain_negatives(rows):
    x = [(i, java_mod(c + 1, 10) if i is not None and i % 7 == 0 else c, v) for i, c, v in good(rows, 256) if c is not None]
    out = []
    for a, (i, c, v) in enumerate(x):
        if i is None or i % 100:
            continue
        score = [sum(p * q for p, q in zip(v, w)) for _, _, w in x]
        near = first([(score[b], j) for b, (j, d, _) in enumerate(x) if b != a and d == c], 5)
        for s, p in near:
            found = [(score[b], j) for b, (j, d, _) in enumerate(x) if d != c and 80 * s <= 100 * score[b] <= 100 * s]
            out += [(i, p, rank, j, s, t) for rank, (t, j) in enumerate(first(found, 5), 1)]
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_top_products(spark, monkeypatch):
    monkeypatch.setattr(inner_products, "CANDIDATES", 16)
    monkeypatch.setattr(inner_products, "QUERIES", 5)
    monkeypatch.setattr(inner_products, "RUN", 4)
    monkeypatch.setattr(inner_products, "MORE", 2)
    rows, df = table(spark)
    for k in (3, 20):
        assert rows_of(inner_products.top_products(df, F.col("vec_id") % 20 == 0, k)) == plain_top(rows, 20, k)
    # fewer rows than asked for
    few = df.where("vec_id in (20, 21, 1000)")
    assert rows_of(inner_products.top_products(few, F.col("vec_id") % 20 == 0)) == plain_top(
        [r for r in rows if r[0] in (20, 21, 1000)], 20, 20)
    assert inner_products.top_products(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0
    assert inner_products.top_products(df.where("vec_id = 1100"), F.col("vec_id") % 20 == 0).count() == 0


def test_search_ends_when_lengths_fall(spark, monkeypatch):
    """Queries are through after the long vectors: short ones are not looked at."""
    monkeypatch.setattr(inner_products, "CANDIDATES", 32)
    r = np.random.default_rng(2)
    x = r.normal(size=(300, 8))
    x *= (np.where(np.arange(300) < 60, 50.0, 0.5) / np.sqrt((x * x).sum(1)))[:, None]
    rows = [(i, v.astype(np.float32).tolist(), 0) for i, v in enumerate(x)]
    df = spark.createDataFrame([(*v, *"abcdefgh") for v in rows], SCHEMA)
    seen = []
    real = inner_products.arrow_pairs
    monkeypatch.setattr(inner_products, "arrow_pairs",
                        lambda one, two, *rest: seen.append(two.select("rid").distinct().count()) or real(one, two, *rest))
    got = rows_of(inner_products.top_products(df, F.col("vec_id") % 20 == 0, 5))
    x64 = np.floor(64 * x.astype(np.float32).astype(float)).astype(int)
    want = []
    for i in range(0, 300, 20):
        s = x64 @ x64[i]
        want += [(i, rank, j, t) for rank, (t, j) in enumerate(first([(int(s[j]), j) for j in range(300) if j != i], 5), 1)]
    assert got == sorted(want, key=repr)
    assert sum(seen) < 300


def test_products_are_exact():
    r = np.random.default_rng(3)
    for top in (100, 1 << 29, 1 << 31, 1 << 40):
        a, b = r.integers(-top, top, (5, 3)), r.integers(-top, top, (4, 3))
        if top < 1 << 31:
            want = [[sum(int(p) * int(q) for p, q in zip(u, v)) for v in b] for u in a]
            assert vectors.products(a, b).tolist() == want
    with pytest.raises(OverflowError):
        vectors.products(np.full((1, 2), 1 << 40), np.full((1, 2), 1 << 40))
    far = np.array([[1 << 40, 1]]), np.array([[0, 5]])
    assert vectors.products(*far).tolist() == [[5]]


def test_subset_sums_and_bit_planes():
    r = np.random.default_rng(4)
    for dim, top in ((1, 3), (8, 200), (13, 1 << 20), (64, 255)):
        a, b = r.integers(-top, top + 1, (7, dim)), r.integers(-top, top + 1, (9, dim))
        b[0], b[1] = -top, top
        planes = top.bit_length() + 1
        tables = hard_negatives.subset_sums(a, hard_negatives.sum_type(a, planes))
        assert tables.shape == (-(-dim // 8), 256, 7)
        assert (hard_negatives.scores(tables, hard_negatives.bit_planes(b, planes)) == b @ a.T).all()


def test_hard_negatives(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHORS", 2)
    monkeypatch.setattr(hard_negatives, "CANDIDATES", 20)
    monkeypatch.setattr(hard_negatives, "_TABLES", 3)
    monkeypatch.setattr(hard_negatives, "_RUN", 7)
    rows, df = table(spark, seed=6, n=420)
    anchor, label = F.col("vec_id") % 100 == 0, hard_negatives.shifted_label()
    want = plain_negatives(rows)
    assert len(want) > 20 and rows_of(hard_negatives.mine(df, anchor, label)) == want
    assert hard_negatives.mine(df.where("false"), anchor, label).count() == 0
    assert hard_negatives.mine(df.where("label is null"), anchor, label).count() == 0


def plain_whitening(rows, dim=6):
    x = np.array([v for _, _, v in good(rows, 64, dim)], object) + 1_000_000
    n, sums = len(x), x.sum(0)
    far = n * x - sums
    centred = far.astype(float) / n
    values, vecs = np.linalg.eigh(centred.T @ centred / n)
    values, vecs = values[::-1], vecs[:, ::-1]
    return [int(v) for v in (far * far).sum(1)], centred @ vecs / np.sqrt(values), values / values.sum()


def test_whitening(spark):
    rows, df = table(spark, seed=5)
    x = good(rows, 64)
    deviation, white, explained = plain_whitening(rows)
    out = whitening.whiten(df)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    got = out.collect()
    assert len(got) == len(x) * 6 and {r.n for r in got} == {len(x)} and {r.component for r in got} == set(range(1, 7))
    assert max(r.identity_error for r in got) < 1e-10 and len({r.identity_error for r in got}) == 1
    for k in range(6):
        own = [r for r in got if r.component == k + 1]
        assert all(abs(r.explained - explained[k]) < 1e-12 for r in own)
        signs = []
        for key in (lambda i, w: (-1 if i is None else i, w),):
            a = sorted(((-1 if r.vec_id is None else r.vec_id, int(r.deviation), r.whitened) for r in own), key=lambda t: t[:2])
            b = sorted(((-1 if i is None else i, deviation[j], white[j, k]) for j, (i, _, _) in enumerate(x)), key=lambda t: t[:2])
            assert [t[:2] for t in a] == [t[:2] for t in b]
            p, q = np.array([t[2] for t in a]), np.array([t[2] for t in b])
            signs.append(min(np.abs(p - q).max(), np.abs(p + q).max()))
        assert max(signs) < 1e-8


def test_whitening_without_variance(spark):
    rows, df = table(spark, seed=5)
    assert whitening.whiten(df.where("false")).count() == 0
    assert whitening.whiten(df.where("vec_id >= 2000")).count() == 0
    assert whitening.whiten(df.where("vec_id = 1100")).count() == 0
    one = whitening.whiten(df.where("vec_id = 7")).collect()
    assert [(r.n, int(r.deviation), r.whitened, r.explained, r.identity_error) for r in one] == [(1, 0, None, None, None)] * 6
    # two vectors: one component with variance
    two = sorted(whitening.whiten(df.where("vec_id in (7, 8)")).collect(), key=lambda r: (r.component, r.vec_id))
    assert sorted(round(abs(r.whitened), 9) for r in two if r.component == 1) == [1.0, 1.0]
    assert all(r.whitened is None for r in two if r.component > 1)
    assert two[0].identity_error < 1e-10 and abs(two[0].explained - 1) < 1e-12
    # components far beyond a long's half
    wide = spark.createDataFrame([(1, [3e38, 1.0], 1), (2, [-3e38, 2.0], 1), (3, [0.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    with pytest.raises(Exception, match="(?i)overflow|precision|decimal"):
        whitening.whiten(wide.union(wide)).collect()


def eigen(a, k):
    d, e, q = whitening.tridiagonal(a)
    values = whitening.leading_values(d, e, k)
    return d, e, q, values, q @ whitening.leading_vectors(d, e, values)


def test_eigenvectors_of_hard_matrices():
    r = np.random.default_rng(7)
    for n, spectrum in ((1, [3.0]), (2, [2.0, 2.0]), (12, [5.0] * 12), (30, [9.0] * 10 + [1.0] * 15 + [0.0] * 5),
                        (40, np.geomspace(1, 1e-9, 40)), (25, [1 + 1e-13 * i for i in range(25)]), (64, r.exponential(size=64)),
                        (20, [0.0] * 20)):
        turn = np.linalg.qr(r.normal(size=(n, n)))[0]
        spectrum = np.sort(np.array(spectrum, float))[::-1]
        a = (turn * spectrum) @ turn.T
        a = (a + a.T) / 2
        d, e, q, values, vecs = eigen(a, min(n, 32))
        top = max(1e-300, spectrum[0])
        t = np.diag(d) + np.diag(e, 1) + np.diag(e, -1)
        assert np.abs(q @ t @ q.T - a).max() <= 1e-13 * max(top, 1e-290) * n
        assert np.abs(values - spectrum[:len(values)]).max() <= 1e-13 * top * n + 1e-290
        assert np.abs(vecs.T @ vecs - np.eye(len(values))).max() < 1e-11
        assert np.abs(a @ vecs - vecs * values).max() <= 1e-12 * top * n + 1e-290
    # a matrix that falls into blocks
    a = np.zeros((9, 9))
    a[:3, :3], a[3:6, 3:6], a[6:, 6:] = 2 * np.ones((3, 3)), 2 * np.ones((3, 3)), np.eye(3)
    _, _, _, values, vecs = eigen(a, 9)
    assert np.abs(values - np.linalg.eigvalsh(a)[::-1]).max() < 1e-13
    assert np.abs(vecs.T @ vecs - np.eye(9)).max() < 1e-11 and np.abs(a @ vecs - vecs * values).max() < 1e-12
