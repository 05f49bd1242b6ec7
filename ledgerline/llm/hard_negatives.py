"""Hard negatives: for anchors and their nearest rows of the same label, the nearest rows of other labels.

Scores are exact inner products of whole-number vectors, by the method of the four Russians. An anchor's components are
taken in groups of eight; a table holds the sum of every subset of a group, 256 sums. A candidate is stored as
bit planes: plane p has bit p of every component (two's complement), eight components a byte. The byte of a plane and
a group is an index into the group's table, the sums of all groups are the plane's product with the anchor, and the planes
are shifted by their place and added, the last one (the sign) taken off. A table serves a whole block of candidates.

Anchors meet candidates block by block, twice: first those of their own label, which gives the positives, then all,
which gives the negatives in the positives' score windows. A block returns the few best rows of each
anchor and positive; a window keeps the best of all blocks. Blocks are dealt by row, so a hot label or vector makes more
blocks and not larger ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map, arrow_pairs, stored
from ledgerline.llm.vectors import dimension, largest, matrix, usable, whole

#: Rows a block has on average.
ANCHORS, CANDIDATES = 1024, 8192
#: Anchors whose tables are held, and candidates looked up, at once.
_TABLES, _RUN = 128, 1024
_FAR = np.iinfo(np.int64).max


def bit_planes(x: np.ndarray, planes: int) -> np.ndarray:
    """(rows, planes, groups) bytes: bit p of components 8 g to 8 g + 7, for ``planes`` bits of two's complement."""
    n, dim = x.shape
    wide = np.zeros((n, -(-dim // 8) * 8), np.int64)
    wide[:, :dim] = x
    bits = (wide[:, None, :] >> np.arange(planes)[:, None]) & 1
    return np.packbits(bits.astype(np.uint8), axis=2, bitorder="little")


def subset_sums(anchors: np.ndarray, dtype: type) -> np.ndarray:
    """(groups, 256, anchors): for each group of eight components the sums of all its subsets."""
    m, dim = anchors.shape
    groups = -(-dim // 8)
    wide = np.zeros((m, groups * 8), np.int64)
    wide[:, :dim] = anchors
    by_group = wide.reshape(m, groups, 8).transpose(1, 2, 0)
    out = np.zeros((groups, 256, m), np.int64)
    for j in range(8):
        out[:, 1 << j:2 << j] = out[:, :1 << j] + by_group[:, j, None]
    return out.astype(dtype)


def scores(tables: np.ndarray, packed: np.ndarray) -> np.ndarray:
    """(rows, anchors) inner products from subset sums and bit planes."""
    n, planes, groups = packed.shape
    total = np.zeros((n, tables.shape[2]), tables.dtype)
    plane, part = np.empty_like(total), np.empty_like(total)
    for p in range(planes):
        plane[:] = 0
        for g in range(groups):
            np.take(tables[g], packed[:, p, g], axis=0, out=part)
            plane += part
        plane <<= p
        if p < planes - 1:
            total += plane
        else:
            total -= plane
    return total


def sum_type(anchors: np.ndarray, planes: int) -> type:
    """The narrowest integers that hold every score and part of one; OverflowError if a long may not."""
    bound = largest(anchors) * max(1, anchors.shape[1]) << planes
    if bound >= 1 << 63:
        raise OverflowError("components too large: an inner product may not fit a long")
    return np.int32 if bound < 1 << 31 else np.int64


def _each(anchors: pa.Table, block: pa.Table, dim: int, planes: int):
    """For a run of candidates and anchors: first candidate, first anchor, their (candidates, anchors) scores."""
    x = matrix(anchors["x"], dim)
    groups = -(-dim // 8)
    raw = block["bits"].combine_chunks()
    packed = np.frombuffer(b"".join(raw.to_pylist()), np.uint8).reshape(len(raw), planes, groups)
    dtype = sum_type(x, planes)
    for i in range(0, len(x), _TABLES):
        tables = subset_sums(x[i:i + _TABLES], dtype)
        for j in range(0, len(packed), _RUN):
            yield i, j, scores(tables, packed[j:j + _RUN])


def _ids(block: pa.Table) -> np.ndarray:
    return block["vec_id"].combine_chunks().fill_null(_FAR).to_numpy()


def _first(keys: list[np.ndarray], order: list[np.ndarray], k: int) -> np.ndarray:
    """Indices of the first ``k`` rows of every key by ``order`` (most significant first)."""
    at = np.lexsort(tuple(reversed([*keys, *order])))
    sorted_keys = [x[at] for x in keys]
    new = np.ones(len(at), bool)
    new[1:] = np.any([x[1:] != x[:-1] for x in sorted_keys], axis=0) if len(at) > 1 else new[1:]
    start = np.maximum.accumulate(np.where(new, np.arange(len(at)), 0)) if len(at) else at
    return at[np.arange(len(at)) - start < k]


def _positives(k: int, dim: int, planes: int):
    """The ``k`` best rows of a block for each anchor, itself left out."""

    def find(anchors: pa.Table, block: pa.Table) -> pa.Table:
        own, other, ids = anchors["rid"].to_numpy(), block["rid"].to_numpy(), _ids(block)
        best = [np.zeros(0, np.int64) for _ in range(3)]  # anchor, candidate, score
        floor = np.full(len(own), -_FAR)
        for i, j, s in _each(anchors, block, dim, planes):
            m = s.shape[1]
            c, a = np.nonzero((s >= floor[i:i + m]) & (other[j:j + len(s), None] != own[i:i + m]))
            found = [np.concatenate([old, new]) for old, new in zip(best, (a + i, c + j, s[c, a].astype(np.int64)))]
            keep = _first([found[0]], [-found[2], ids[found[1]], other[found[1]]], k)
            best = [x[keep] for x in found]
            counts = np.bincount(best[0], minlength=len(own))
            low = np.full(len(own), _FAR)
            np.minimum.at(low, best[0], best[2])
            floor = np.where(counts >= k, low, -_FAR)
        return pa.table({"rid": own[best[0]], "score": best[2], "vec_id": pa.array(ids[best[1]], mask=ids[best[1]] == _FAR),
                         "other": other[best[1]]})

    return find


def _negatives(k: int, low_percent: int, high_percent: int, dim: int, planes: int):
    """The ``k`` best rows of a block in the window of each positive of each anchor, the anchor's label left out."""

    def find(anchors: pa.Table, block: pa.Table) -> pa.Table:
        own, label = anchors["rid"].to_numpy(), anchors["label"].to_numpy()
        other, other_label, ids = block["rid"].to_numpy(), block["label"].to_numpy(), _ids(block)
        lists = anchors["windows"].combine_chunks()
        limits = lists.flatten().to_numpy()
        at = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        slots = int(np.diff(at).max(initial=0))
        best = [np.zeros(0, np.int64) for _ in range(4)]  # anchor, positive, candidate, score
        for i, j, s in _each(anchors, block, dim, planes):
            n, m = s.shape
            apart = other_label[j:j + n, None] != label[i:i + m]
            new = []
            for slot in range(slots):
                has = np.flatnonzero(at[i:i + m] + slot < at[i + 1:i + m + 1])
                goal = limits[at[i + has] + slot]
                # on whole numbers: score >= ceil(low p / 100) and score <= floor(high p / 100)
                low, high = -(-low_percent * goal // 100), high_percent * goal // 100
                c, a = np.nonzero(apart[:, has] & (s[:, has] >= low) & (s[:, has] <= high))
                new.append((has[a] + i, np.full(len(a), slot), c + j, s[c, has[a]].astype(np.int64)))
            found = [np.concatenate([old, *(x[f] for x in new)]) for f, old in enumerate(best)]
            keep = _first(found[:2], [-found[3], ids[found[2]], other[found[2]]], k)
            best = [x[keep] for x in found]
        return pa.table({"rid": own[best[0]], "slot": best[1], "score": best[3],
                         "vec_id": pa.array(ids[best[2]], mask=ids[best[2]] == _FAR), "other": other[best[2]]})

    return find


def _packed(rows: DataFrame, dim: int, planes: int) -> DataFrame:
    """``rows`` with the bit planes of ``x`` as bytes."""

    def run(batches):
        for batch in batches:
            if batch.num_rows:
                planes_of = bit_planes(matrix(batch.column("x"), dim), planes).reshape(batch.num_rows, -1)
                yield batch.append_column("bits", pa.array([r.tobytes() for r in planes_of], pa.binary()))

    return arrow_map(rows, run, "rid long, vec_id long, label long, anchor boolean, x array<long>, bits binary")


def _blocks(n: Column | int, size: int) -> Column:
    """How many blocks of ``size`` rows on average ``n`` rows make."""
    return F.greatest(F.lit(1), F.ceil((F.lit(n) if isinstance(n, int) else n) / size)).cast("long")


def _dealt(n: Column) -> Column:
    return F.pmod(F.xxhash64("rid"), n)


def _upto(n: Column) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("long"), n - 1))


def mine(rows: DataFrame, anchor: Column, label: Column, positives: int = 5, negatives: int = 5, low_percent: int = 80,
         high_percent: int = 100, scale: int = 256, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of every anchor of ``rows``.

    ``anchor`` tells which rows are anchors, ``label`` gives a row's label (a whole number); components x count as
    floor(``scale`` x). An anchor's positives are its ``positives`` best other rows of its label; each gets the best
    ``negatives`` rows of other labels whose score lies from ``low_percent`` to ``high_percent`` % of the positive's.
    Higher scores come first, ties by smaller id, null ids last; fewer rows give all, a positive without any gives
    no row. Rows with a null label, or with a vector that is null or holds null or non-finite components, take no
    part; shorter vectors are filled up with zeros. Rows that repeat an id or vector each count, as anchors too.
    An empty table gives an empty result; other columns are not read. Components so large that a score may not fit a long are
    an error.
    """
    good = rows.where(usable(F.col(vec_col)) & label.isNotNull())
    dim = dimension(good, vec_col)
    base = stored(good.select(F.col(id_col).cast("long").alias("vec_id"), label.cast("long").alias("label"),
                              F.coalesce(anchor, F.lit(False)).alias("anchor"), whole(F.col(vec_col), scale, dim).alias("x"))
                  .select(F.monotonically_increasing_id().alias("rid"), "vec_id", "label", "anchor", "x"), "whole-vectors")
    n, m, high, low = base.agg(F.count(F.lit(1)), F.count_if("anchor"), F.max(F.array_max("x")), F.min(F.array_min("x"))).first()
    planes = max(int(high or 0).bit_length(), (~int(min(low or 0, 0))).bit_length()) + 1
    all_rows = stored(_packed(base, dim, planes), "bit-planes")
    anchors = stored(base.where("anchor").select("rid", "vec_id", "label", "x"), "anchors")
    # labels with anchors, and how many blocks each makes
    per_label = stored(base.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.count_if("anchor").alias("m"))
                       .where("m > 0").select("label", _blocks(F.col("n"), CANDIDATES).alias("cs"),
                                              _blocks(F.col("m"), ANCHORS).alias("as")), "labels")
    left = anchors.join(per_label, "label").select("rid", "x", "label", _dealt(F.col("as")).alias("a"),
                                                   _upto(F.col("cs")).alias("c"))
    right = all_rows.join(per_label, "label").select("rid", "vec_id", "bits", "label", _dealt(F.col("cs")).alias("c"),
                                                     _upto(F.col("as")).alias("a"))
    found = arrow_pairs(left, right, ["label", "a", "c"], _positives(positives, dim, planes),
                        "rid long, score long, vec_id long, other long")
    place = Window.partitionBy("rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    near = stored(found.withColumn("slot", F.row_number().over(place) - 1).where(F.col("slot") < positives), "positives")
    # an anchor has a handful of positives at most
    windows = near.groupBy("rid").agg(F.transform(F.array_sort(F.collect_list(F.struct("slot", "score"))),
                                                  lambda s: s["score"]).alias("windows"))
    a_blocks, c_blocks = _blocks(m, ANCHORS), _blocks(n, CANDIDATES)
    left = anchors.join(windows, "rid").select("rid", "x", "label", "windows", _dealt(a_blocks).alias("a"),
                                               _upto(c_blocks).alias("c"))
    right = all_rows.select("rid", "vec_id", "bits", "label", _dealt(c_blocks).alias("c"), _upto(a_blocks).alias("a"))
    found = arrow_pairs(left, right, ["a", "c"], _negatives(negatives, low_percent, high_percent, dim, planes),
                        "rid long, slot long, score long, vec_id long, other long")
    place = Window.partitionBy("rid", "slot").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    last = (found.withColumn("rank", F.row_number().over(place)).where(F.col("rank") <= negatives)
            .select("rid", "slot", "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))
    pairs = near.select("rid", "slot", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (last.join(pairs, ["rid", "slot"]).join(anchors.select("rid", F.col("vec_id").alias("anchor_id")), "rid")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))


def shifted_label(id_col: str = "vec_id", label_col: str = "label") -> Column:
    """The label, and the next one of ten where the id is divisible by 7."""
    label = F.col(label_col).cast("long")
    return F.when(F.col(id_col) % 7 == 0, (label + 1) % 10).otherwise(label)


def mine_sql() -> str:
    """DuckDB SQL for the hard negatives of ``embeddings``."""
    return """
WITH good AS (SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                     [floor(256 * x::DOUBLE) for x in embedding] AS x
              FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
pairs AS (SELECT a.rid, a.vec_id AS anchor_id, c.rid AS other, c.vec_id, a.label = c.label AS same,
                 list_inner_product(a.x, c.x)::BIGINT AS score
          FROM good a JOIN good c ON a.rid <> c.rid WHERE a.vec_id % 100 = 0),
pos AS (SELECT rid, other, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
        QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST) <= 5)
SELECT anchor_id, positive_id,
       row_number() OVER (PARTITION BY pos.rid, pos.other ORDER BY n.score DESC, n.vec_id NULLS LAST)::INTEGER AS rank,
       n.vec_id AS negative_id, positive_score, n.score AS negative_score
FROM pos JOIN pairs n ON n.rid = pos.rid AND NOT n.same
 AND 80 * positive_score <= 100 * n.score AND 100 * n.score <= 100 * positive_score
QUALIFY rank <= 5
"""
