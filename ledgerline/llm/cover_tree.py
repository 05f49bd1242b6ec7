"""Near-duplicate embeddings: exact threshold pairs by dual traversal of cover trees.

Vectors are compared by cosine; on the unit sphere a cosine of at least c is a distance of at
most t = sqrt(2 - 2c).

1. Equal vectors become one, with their number.
2. A top net of pivots (farthest-first over a bounded sample) parts the vectors into cells, and
   large cells into blocks of bounded size.
3. Each block gets a cover tree: nested levels of centres with halving radii, every
   vector under its nearest centre of the finest level, every centre under its nearest centre of
   the level above. Children are stored next to each other, so a node is a range.
4. Blocks are paired unless their covering radii keep them more than t apart. A pair of
   trees is traversed from the top: a node pair whose centres are further apart than t plus
   both covering radii is pruned; one whose centres are closer than t less both radii is linked
   as a whole, without looking at its members; all others are replaced by their children.
5. Each task returns, for a vector with links, their number and one vector it is joined with;
   numbers are added up and the joins give the components.

A level that hardly coarsens the next one is skipped, and where most node pairs survive, the next
level is evaluated as a matrix product instead of pair by pair.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, stored
from ledgerline.llm.graph import components

#: Radii of the nested levels.
RADII = (1.0, 0.5, 0.25, 0.125)
#: Vectors a cell has on average, pivots at most, vectors the net is chosen from, vectors a block has at most.
CELL, MAX_PIVOTS, NET_SAMPLE, BLOCK = 2048, 1024, 8192, 4096
_MARGIN = 1e-9


def unit(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of a list column as double unit vectors of ``dim`` components (shorter ones are filled with zeros)."""
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    if len(lengths) and (lengths == dim).all():
        out = values.reshape(-1, dim).copy()
    else:
        out = np.zeros((len(lengths), dim))
        row = np.repeat(np.arange(len(lengths)), lengths)
        out[row, np.arange(len(row)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = values
    # scaled first, so that squares neither overflow nor vanish
    out /= np.abs(out).max(1, keepdims=True, initial=1e-300)
    return out / np.sqrt((out * out).sum(1, keepdims=True))


def farthest_first(x: np.ndarray, k: int) -> np.ndarray:
    """Row numbers of up to ``k`` pivots, each the row farthest from those before."""
    chosen, best = [0], x @ x[0]
    while len(chosen) < min(k, len(x)):
        i = int(best.argmin())
        if best[i] > 1 - 1e-12:
            break
        chosen.append(i)
        best = np.maximum(best, x @ x[i])
    return np.array(chosen)


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * cosine))


def net(x: np.ndarray, centres: np.ndarray, radius: float) -> np.ndarray:
    """``centres`` and, in order, every row farther than ``radius`` from all centres before it."""
    low = 1 - radius * radius / 2  # cosine at that distance
    best = (x @ x[centres].T).max(1, initial=-2.0) if len(centres) else np.full(len(x), -2.0)
    out = list(centres)
    for i in range(0, len(x), 256):
        fresh = []
        for r in np.flatnonzero(best[i:i + 256] < low) + i:
            if best[r] < low:
                fresh.append(r)
                best[i:i + 256] = np.maximum(best[i:i + 256], x[i:i + 256] @ x[r])
        if fresh:
            best[i + 256:] = np.maximum(best[i + 256:], (x[i + 256:] @ x[fresh].T).max(1, initial=-2.0))
            out += fresh
    return np.array(out)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """For each row the number (in ``centres``) of the nearest centre."""
    out = np.empty(len(x), np.int64)
    for i in range(0, len(x), 1024):
        out[i:i + 1024] = (x[i:i + 1024] @ x[centres].T).argmax(1)
    return out


def build(x: np.ndarray) -> np.ndarray:
    """(rows, levels): each row's centre (a row number) at every level, coarse to fine."""
    levels, centres = [], np.zeros(0, np.int64)
    for radius in RADII:
        centres = net(x, centres, radius)
        levels.append(centres)
    path = np.empty((len(x), len(RADII)), np.int64)
    path[:, -1] = levels[-1][_nearest(x, levels[-1])]
    for level in range(len(RADII) - 2, -1, -1):
        fine = levels[level + 1]
        up = np.zeros(len(x), np.int64)
        up[fine] = levels[level][(x[fine] @ x[levels[level]].T).argmax(1)]
        path[:, level] = up[path[:, level + 1]]
    return path


class Tree:
    """A block's vectors in tree order; a level lists its nodes' centres, radii, ranges and weights."""

    def __init__(self, x: np.ndarray, path: np.ndarray, weight: np.ndarray):
        order = np.lexsort(path.T[::-1])
        self.order, self.x, self.weight = order, x[order], weight[order]
        self.sums = np.concatenate([[0.0], np.cumsum(self.weight)])
        n = len(x)
        self.levels = []
        for level in range(path.shape[1]):
            own = path[order, level]
            first = np.flatnonzero(np.concatenate([[True], (path[order, :level + 1][1:] != path[order, :level + 1][:-1]).any(1)]))
            stop = np.append(first[1:], n)
            centre = x[own[first]]
            far = _distance((self.x * np.repeat(centre, stop - first, axis=0)).sum(1))
            self.levels.append((centre, np.maximum.reduceat(far, first) + 1e-12, first, stop))
        self.levels.append((self.x, np.zeros(n), np.arange(n), np.arange(1, n + 1)))
        kept = [self.levels[-1]]
        for level in reversed(self.levels[:-1]):
            if len(level[2]) <= 0.7 * len(kept[-1][2]):
                kept.append(level)
        self.levels = kept[::-1]

    def children(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        """First and last + 1 node of the next level for each node of ``level``."""
        _, _, first, stop = self.levels[level]
        below = self.levels[level + 1][2]
        return np.searchsorted(below, first), np.searchsorted(below, stop)

    def stay(self, level: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(self.levels[level][2])
        return np.arange(n), np.arange(1, n + 1)


def connect(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the labels of ``a[i]`` and ``b[i]`` (smallest first), in place."""
    while len(a):
        la, lb = label[a], label[b]
        apart = la != lb
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        if not len(a):
            break
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while (label[label] != label).any():
            label[:] = label[label]


def dual(one: Tree, two: Tree, cosine: float, same: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(links of each row of ``one``, of ``two``, labels of both): all pairs at ``cosine`` and more.

    ``same``: both are one tree; a row does not link with itself, and all links are in the first array.
    """
    t = math.sqrt(2 - 2 * cosine)
    n1, n2 = len(one.x), len(two.x)
    gain1, gain2 = np.zeros(n1 + 1), np.zeros(n2 + 1)  # differences: added to all rows from here on
    itself = np.zeros(n1 + 1)
    links1, links2 = np.zeros(n1), np.zeros(n2)
    label = np.arange(n1 + n2)
    shift = 0 if same else n1

    def whole(u, v, l1, l2):
        """All rows of node u are linked with all of node v."""
        (_, _, f1, s1), (_, _, f2, s2) = one.levels[l1], two.levels[l2]
        a, b, c, d = f1[u], s1[u], f2[v], s2[v]
        w2, w1 = two.sums[d] - two.sums[c], one.sums[b] - one.sums[a]
        np.add.at(gain1, a, w2)
        np.add.at(gain1, b, -w2)
        other = ~(same & (u == v))
        np.add.at(itself, a[~other], 1)
        np.add.at(itself, b[~other], -1)
        np.add.at(gain2, c[other], w1[other])
        np.add.at(gain2, d[other], -w1[other])
        for lo, n, mate in ((a, b - a, c + shift), (c + shift, d - c, a)):
            rows = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            connect(label, rows, np.repeat(mate, n))

    def judge(u, v, cos, l1, l2):
        """Settle node pairs with centres at ``cos``; the pairs to open."""
        c1, r1, _, _ = one.levels[l1]
        c2, r2, _, _ = two.levels[l2]
        d, r = _distance(cos), r1[u] + r2[v]
        if l1 == len(one.levels) - 1 and l2 == len(two.levels) - 1:
            close = cos >= cosine
            doubt = np.flatnonzero(np.abs(cos - cosine) < 1e-12)
            if len(doubt):
                p, q = c1[u[doubt]], c2[v[doubt]]
                close[doubt] = (p * q).sum(1) / np.sqrt((p * p).sum(1) * (q * q).sum(1)) >= cosine
            u, v = u[close], v[close]
            np.add.at(links1, u, two.weight[v])
            np.add.at(links2, v, one.weight[u])
            connect(label, u, v + shift)
            return u[:0], v[:0], u[:0], v[:0]
        inside = d + r <= t - _MARGIN
        if inside.any():
            whole(u[inside], v[inside], l1, l2)
        open_ = ~inside & (d <= t + r + _MARGIN)
        return u[open_], v[open_], u[inside], v[inside]

    def matrix(l1, l2, done):
        """All node pairs of two levels; ``done``: keys of pairs of the levels above that are settled."""
        c1, r1, _, _ = one.levels[l1]
        c2, r2, _, _ = two.levels[l2]
        low = 1 - (t + r1 + r2.max() + 2 * _MARGIN) ** 2 / 2
        low = np.where(t + r1 + r2.max() >= 2, -2.0, low) - 1e-12
        opened, settled = [], []
        for i in range(0, len(c1), 512):
            cos = c1[i:i + 512] @ c2.T
            u, v = np.nonzero(cos >= low[i:i + 512, None])
            cos, u = cos[u, v], u + i
            if same:
                keep = (u < v) | ((u == v) & (l1 < len(one.levels) - 1))
                u, v, cos = u[keep], v[keep], cos[keep]
            if done is not None and len(done[0]):
                key = done[1][u] * len(two.levels[l2 - 1][2]) + done[2][v]
                old = np.isin(key, done[0])
                settled.append(u[old] * len(c2) + v[old])
                u, v, cos = u[~old], v[~old], cos[~old]
            a, b, p, q = judge(u, v, cos, l1, l2)
            opened.append((a, b))
            settled.append(p * len(c2) + q)
        return (*(np.concatenate(z) for z in zip(*opened)), np.concatenate(settled))

    def pieces(u, v, f1, s1, f2, s2, l1, l2):
        """Children of the node pairs and their cosines, a bounded number at a time."""
        c1, c2 = one.levels[l1][0], two.levels[l2][0]
        n = (s1 - f1)[u] * (s2 - f2)[v]
        for k in np.flatnonzero(n > 50_000):
            a, b, c, d = f1[u[k]], s1[u[k]], f2[v[k]], s2[v[k]]
            for i in range(a, b, 256):
                p, q = np.divmod(np.arange((min(i + 256, b) - i) * (d - c)), d - c)
                yield p + i, q + c, (c1[i:min(i + 256, b)] @ c2[c:d].T).ravel()
        few = n <= 50_000
        u, v, n = u[few], v[few], n[few]
        cuts = np.unique(np.append(np.searchsorted(np.cumsum(n), np.arange(0, n.sum(), 50_000)), len(n)))
        for i, j in zip(cuts[:-1], cuts[1:]):
            m, a, b = n[i:j], u[i:j], v[i:j]
            wide = np.repeat((s2 - f2)[b], m)
            inner = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            p, q = np.repeat(f1[a], m) + inner // wide, np.repeat(f2[b], m) + inner % wide
            yield p, q, np.einsum("ij,ij->i", c1[p], c2[q])

    # both trees are opened level by level; the shallower one waits at its top
    depth = max(len(one.levels), len(two.levels))
    at = [[max(0, k - depth + len(tree.levels)) for k in range(depth)] for tree in (one, two)]
    u, v, settled = matrix(at[0][0], at[1][0], None)
    dense = True
    for k in range(1, depth):
        l1, l2 = at[0][k], at[1][k]
        (f1, s1), (f2, s2) = (tree.children(level - 1) if level > at[i][k - 1] else tree.stay(level)
                              for i, (tree, level) in enumerate(((one, l1), (two, l2))))
        many = len(one.levels[l1][2]) * len(two.levels[l2][2])
        dense = dense and l1 > at[0][k - 1] and l2 > at[1][k - 1] and 10 * ((s1 - f1)[u] * (s2 - f2)[v]).sum() > many
        if dense:
            u, v, settled = matrix(l1, l2, (settled, np.repeat(np.arange(len(f1)), s1 - f1),
                                            np.repeat(np.arange(len(f2)), s2 - f2)))
            continue
        opened = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for p, q, cos in pieces(u, v, f1, s1, f2, s2, l1, l2):
            if same:
                keep = (p < q) | ((p == q) & (l1 < len(one.levels) - 1))
                p, q, cos = p[keep], q[keep], cos[keep]
            opened.append(judge(p, q, cos, l1, l2)[:2])
        u, v = (np.concatenate(z) for z in zip(*opened))
    links1 += np.cumsum(gain1)[:-1]
    links2 += np.cumsum(gain2)[:-1]
    if same:
        links1 += links2 - one.weight * np.cumsum(itself)[:-1]
    return links1, links2, label


def _net_of(vectors: DataFrame, dim: int, n: int) -> np.ndarray:
    """Pivots from a bounded sample (lowest hashes) of the distinct vectors."""
    sample = vectors.orderBy(F.xxhash64("cid")).limit(NET_SAMPLE).select("cid", "embedding").toArrow()
    x = unit(sample["embedding"].combine_chunks(), dim)
    return x[farthest_first(x, min(MAX_PIVOTS, max(1, math.ceil(n / CELL))))]


def near_pairs(vectors: DataFrame, percent: int = 90, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of ``vectors``.

    Rows are linked if their cosine, in double precision, is at least ``percent`` / 100. A vector that is
    null, empty, zero or holds null or non-finite components links with nothing. Equal vectors are
    linked with each other, repeated rows too. A vector with fewer components than others counts as filled with zeros.
    component_id is the smallest id reachable by links, itself included; a row with a null id can
    be linked but not name a component. Other columns are not read; an empty table gives an empty result.
    """
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"),
                          F.col(vector_col).cast("array<double>").alias("embedding"))
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    valid = F.coalesce(finite & F.exists("embedding", lambda x: x != 0), F.lit(False))
    rows = stored(rows.withColumn("embedding", F.when(valid, F.col("embedding"))), "vectors")
    key = [F.xxhash64("embedding").alias("k1"), F.xxhash64(F.lit(1), "embedding").alias("k2")]
    classes = rows.where("embedding is not null").groupBy("embedding").agg(
        F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies"))
    classes = stored(classes.withColumn("cid", F.monotonically_increasing_id()).select("*", *key), "distinct-vectors")
    alone = rows.where("embedding is null").select("vec_id", F.lit(0).cast("long").alias("n_links"),
                                                   F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    n, dim = classes.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    if not n:
        return alone
    found = _traverse(classes, percent / 100, int(dim), n)
    sums = found.groupBy("cid").agg(F.sum("links").alias("links"))
    roots = components(found.where("cid <> mate").select(F.col("cid").alias("a"), F.col("mate").alias("b")))
    named = stored(classes.select("cid", "k1", "k2", "low", "copies").join(sums, "cid", "left")
             .join(roots.withColumnRenamed("node", "cid"), "cid", "left")
             .withColumn("root", F.coalesce("root", "cid")), "named")
    lows = stored(named.groupBy("root").agg(F.min("low").alias("component")), "components")
    named = named.join(lows, "root").select(
        "k1", "k2", "component", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("links"))
    linked = rows.where("embedding is not null").select("vec_id", *key).join(named, ["k1", "k2"])
    return linked.select("vec_id", F.col("links").alias("n_links"), F.col("component").alias("component_id"),
                         F.col("vec_id").eqNullSafe(F.col("component")).alias("kept")).unionAll(alone)


def _traverse(classes: DataFrame, cosine: float, dim: int, n: int) -> DataFrame:
    """(cid, links, mate): per task and vector with links, their number and a vector it is joined with."""
    spark = classes.sparkSession
    pivots = _net_of(classes, dim, n)
    shared = spark.sparkContext.broadcast(pivots)  # at most MAX_PIVOTS vectors

    def to_cells(batches):
        for batch in batches:
            x = unit(batch.column(1), dim)
            cos = x @ shared.value.T
            cell = cos.argmax(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), pa.array(_distance(cos[np.arange(len(cell)), cell]))],
                names=["cid", "embedding", "copies", "cell", "far"])

    celled = stored(arrow_map(classes.select("cid", "embedding", "copies"), to_cells,
                              "cid long, embedding array<double>, copies long, cell int, far double"), "cells")
    sizes = celled.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("far").alias("far")).collect()  # <= MAX_PIVOTS
    t = math.sqrt(2 - 2 * cosine)
    far = {r.cell: r.far for r in sizes}
    parts = {r.cell: math.ceil(r.n / BLOCK) for r in sizes}
    apart = _distance(pivots @ pivots.T)
    near = [(a, b) for a in sorted(far) for b in sorted(far)
            if a == b or apart[a, b] <= t + far[a] + far[b] + _MARGIN]
    cells = spark.createDataFrame([(a, parts[a]) for a in parts], "cell int, parts int")
    blocks = celled.join(F.broadcast(cells), "cell").withColumn("part", F.pmod(F.xxhash64("cid"), "parts").cast("int"))

    def plant(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        x = unit(table["embedding"].combine_chunks(), dim)
        path = build(x)
        return table.append_column("at", pa.array(np.arange(len(x), dtype=np.int32))).append_column(
            "path", pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(RADII)),
                                             pa.array(path.astype(np.int32).ravel())))

    kinds = "cell int, part int, cid long, embedding array<double>, copies long"
    trees = stored(blocks.select("cell", "part", "cid", "embedding", "copies").groupBy("cell", "part").applyInArrow(
        plant, kinds + ", at int, path array<int>"), "cover-trees")
    partners = spark.createDataFrame([(a, b, parts[b]) for a, b in near], "cell int, other int, n int").select(
        "cell", "other", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("other_part"))
    # block pairs: every vector goes where its block is compared
    low = F.struct(F.least("cell", "other").alias("c"), F.when(F.col("cell") == F.col("other"), F.least("part", "other_part"))
                   .when(F.col("cell") < F.col("other"), F.col("part")).otherwise(F.col("other_part")).alias("p"))
    high = F.struct(F.greatest("cell", "other").alias("c"),
                    F.when(F.col("cell") == F.col("other"), F.greatest("part", "other_part"))
                    .when(F.col("cell") < F.col("other"), F.col("other_part")).otherwise(F.col("part")).alias("p"))
    paired = trees.join(partners, "cell").withColumn("lo", low).withColumn("hi", high)
    paired = paired.select(F.col("lo.c").alias("c1"), F.col("lo.p").alias("p1"), F.col("hi.c").alias("c2"),
                           F.col("hi.p").alias("p2"), "cell", "part", "cid", "embedding", "copies", "at", "path")

    def compare(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        col = {k: table[k].combine_chunks() for k in table.column_names}
        num = {k: col[k].to_numpy(zero_copy_only=False) for k in ("c1", "p1", "c2", "p2", "cell", "part", "cid", "copies", "at")}
        x = unit(col["embedding"], dim)
        path = col["path"].flatten().to_numpy(zero_copy_only=False).reshape(-1, len(RADII)).astype(np.int64)
        same = num["c1"][0] == num["c2"][0] and num["p1"][0] == num["p2"][0]
        trees, ids = [], []
        for c, p in (("c1", "p1"), ("c2", "p2"))[:1 if same else 2]:
            own = np.flatnonzero((num["cell"] == num[c]) & (num["part"] == num[p]))
            own = own[np.argsort(num["at"][own])]
            if not len(own):
                return table.select(["cid"]).slice(0, 0).append_column("links", pa.array([], pa.int64())).append_column(
                    "mate", pa.array([], pa.int64()))
            trees.append(Tree(x[own], path[own], num["copies"][own].astype(np.float64)))
            ids.append(num["cid"][own][trees[-1].order])
        links1, links2, label = dual(trees[0], trees[-1], cosine, same)
        if same:
            links, every = links1, ids[0]
        else:
            links, every = np.concatenate([links1, links2]), np.concatenate(ids)
        label = label[:len(every)]
        some = np.flatnonzero(np.rint(links) > 0)
        return pa.table({"cid": pa.array(every[some]), "links": pa.array(np.rint(links[some]).astype(np.int64)),
                         "mate": pa.array(every[label[some]])})

    return stored(paired.groupBy("c1", "p1", "c2", "p2").applyInArrow(compare, "cid long, links long, mate long"), "links")
