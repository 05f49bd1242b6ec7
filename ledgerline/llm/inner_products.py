"""Exact top-k search by inner product: candidates by falling length, cut off by Cauchy-Schwarz bounds.

Vectors are whole numbers, scores are exact.

1. All vectors are ranged by falling length and cut into blocks of bounded size. An orthogonal rotation, the right
   singular vectors of all vectors together, moves most of a vector's length into its first coordinates; it follows
   from the sums of products of all vectors and is as large as the vector length squared.
2. Rounds take the blocks in that order, eight times as many each round. In a task one block of queries meets one block of
   candidates, a run of rows at a time:
   - length: a query is through with a run if |q| times the run's greatest length stays below its k-th best score;
   - partial sums: the product of the first rotated coordinates, plus the product of the lengths of the rest
     (Cauchy-Schwarz), bounds the score; where it stays below the k-th best score, the pair is dropped;
   - pairs left are scored exactly.
3. After each round the k best of every query are stored. Queries whose k-th best score cannot be reached by any vector as
   short as the next block's longest take no further part; when none is left, the search ends.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_pairs, stored
from ledgerline.llm.vectors import dimension, matrix, products, second_moments, usable, whole

#: Candidates of a block, queries of a block (on average), blocks more each round, candidates that a task looks at in one go.
CANDIDATES, QUERIES, MORE, RUN = 4096, 1024, 8, 512
#: Share of the squared length that the first rotated coordinates hold.
HEAD = 0.7
#: Bounds are lifted by this share of both lengths, far beyond what rounding can cost.
_SLACK = 1e-9
_FAR = np.iinfo(np.int64).max


def rotation(moments: np.ndarray) -> tuple[np.ndarray, int]:
    """Right singular vectors (columns), strongest first, and how many of them hold ``HEAD`` of the squared length."""
    values, vectors = np.linalg.eigh(moments)
    share = np.cumsum(np.maximum(values[::-1], 0))
    head = int(np.searchsorted(share, HEAD * share[-1])) + 1 if share[-1] > 0 else 1
    return vectors[:, ::-1], min(head, len(values))


class Best:
    """The ``k`` best candidates of each query so far: higher scores first, ties by smaller id, null ids last."""

    def __init__(self, queries: int, k: int, floor: np.ndarray):
        self.k = k
        self.floor = floor  # scores below cannot get among the best
        self.row, self.score, self.id, self.rid = (np.zeros(0, np.int64) for _ in range(4))
        self.n = queries

    def add(self, row: np.ndarray, score: np.ndarray, ids: np.ndarray, rid: np.ndarray) -> None:
        row, score = np.concatenate([self.row, row]), np.concatenate([self.score, score])
        ids, rid = np.concatenate([self.id, ids]), np.concatenate([self.rid, rid])
        order = np.lexsort((rid, ids, -score, row))
        row = row[order]
        place = np.arange(len(row)) - np.searchsorted(row, row)
        order, row, place = (x[place < self.k] for x in (order, row, place))
        self.row, self.score, self.id, self.rid = row, score[order], ids[order], rid[order]
        last = place == self.k - 1
        self.floor[row[last]] = np.maximum(self.floor[row[last]], self.score[last])


def _search(k: int, dim: int, turn: np.ndarray, head: int):
    """The kernel of one query block and one candidate block."""

    def search(queries: pa.Table, block: pa.Table) -> pa.Table:
        block = block.sort_by([("length", "descending")])
        q, c = matrix(queries["x"], dim), matrix(block["x"], dim)
        qr, cr = q @ turn, c @ turn
        q_all, c_all = np.sqrt((qr * qr).sum(1)), np.sqrt((cr * cr).sum(1))
        q_rest, c_rest = (np.sqrt((x[:, head:] ** 2).sum(1)) for x in (qr, cr))
        own, other = queries["rid"].to_numpy(), block["rid"].to_numpy()
        ids = block["vec_id"].combine_chunks().fill_null(_FAR).to_numpy()
        floor = queries["floor"].combine_chunks().fill_null(-_FAR).to_numpy().copy()
        best = Best(len(q), k, floor)
        for i in range(0, len(c), RUN):
            run = slice(i, i + RUN)
            slack = _SLACK * q_all * c_all[run].max()
            on = np.flatnonzero(q_all * c_all[run].max() + slack >= best.floor)
            if not len(on):
                continue
            bound = qr[on, :head] @ cr[run, :head].T + np.outer(q_rest[on], c_rest[run]) + slack[on, None]
            a, b = np.nonzero((bound >= best.floor[on, None]) & (own[on, None] != other[None, run]))
            if not len(a):
                continue
            use_q, at_q = np.unique(a, return_inverse=True)
            use_c, at_c = np.unique(b, return_inverse=True)
            score = products(q[on[use_q]], c[run][use_c])[at_q, at_c]
            good = score >= best.floor[on[a]]
            best.add(on[a[good]], score[good], ids[run][b[good]], other[run][b[good]])
        keep = best.score >= best.floor[best.row]
        row, ids = best.row[keep], best.id[keep]
        return pa.table({"rid": own[row], "score": best.score[keep], "vec_id": pa.array(ids, mask=ids == _FAR),
                         "other": best.rid[keep]})

    return search


def ranged(vectors: DataFrame) -> tuple[DataFrame, int]:
    """``vectors`` by falling length with a ``block`` number, and the number of blocks of at most ``CANDIDATES`` rows.

    Range partitions are cut into blocks where they are; a partition's first block number follows from
    the sizes of the partitions before it, one row a partition.
    """
    order = F.monotonically_increasing_id()
    parts = stored(vectors.repartitionByRange(F.desc("length"), "rid").sortWithinPartitions(F.desc("length"), "rid")
                   .select("*", F.shiftright(order, 33).alias("part"),
                           F.floor(order.bitwiseAND(F.lit((1 << 33) - 1)) / CANDIDATES).alias("sub")), "by-length")
    first, starts = 0, []
    for r in parts.groupBy("part").agg((F.max("sub") + 1).alias("n")).orderBy("part").collect():
        starts.append((r.part, first))
        first += r.n
    numbers = vectors.sparkSession.createDataFrame(starts, "part long, first long")
    return parts.join(F.broadcast(numbers), "part").select("rid", "vec_id", "x", "length",
                                                           (F.col("first") + F.col("sub")).alias("block")), first


def top_products(rows: DataFrame, wanted: Column, k: int = 20, scale: int = 64, id_col: str = "vec_id",
                 vec_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` highest inner products of every query with the other rows.

    Queries are the rows for which ``wanted`` is true, candidates all rows but the query's own; components x count
    as floor(``scale`` x). Fewer candidates give all; ties go to the smaller id, null ids last. Vectors that are null or
    hold null or non-finite components take no part; shorter ones are filled up with zeros. Rows that
    repeat an id or vector each count, as queries too. An empty table gives an empty result; other columns are
    not read. A score outside the long range is an error.
    """
    good = rows.where(usable(F.col(vec_col)))
    dim = dimension(good, vec_col)
    square = F.aggregate("x", F.lit(0.0), lambda s, c: s + c.cast("double") * c.cast("double"))
    base = stored(good.select(F.col(id_col).cast("long").alias("vec_id"), F.coalesce(wanted, F.lit(False)).alias("wanted"),
                              whole(F.col(vec_col), scale, dim).alias("x"))
                  .withColumn("rid", F.monotonically_increasing_id()).withColumn("length", F.sqrt(square)), "whole-vectors")
    turn, head = np.zeros((0, 0)), 0
    if dim:
        turn, head = rotation(second_moments(base, "x", dim, lambda v: v.astype(np.float64)))
    blocks, n_blocks = ranged(base.drop("wanted"))
    blocks = stored(blocks, "blocks")
    groups = max(1, -(-base.where("wanted").count() // QUERIES))
    queries = stored(base.where("wanted").select("rid", F.col("vec_id").alias("query_id"), "x", "length",
                                                 F.pmod(F.xxhash64("rid"), F.lit(groups)).alias("g")), "queries")
    kernel = _search(k, dim, turn, head)
    best = rows.sparkSession.createDataFrame([], "rid long, score long, vec_id long, other long, rank int")
    place = Window.partitionBy("rid").orderBy(F.desc("score"), F.asc_nulls_last("vec_id"), "other")
    start, width = 0, 1
    while start < n_blocks:
        stop = min(start + width, n_blocks)
        ahead = blocks.where(F.col("block") >= start)
        longest = ahead.agg(F.max("length")).first()[0] * (1 + _SLACK)
        floors = best.where(F.col("rank") == k).select("rid", F.col("score").alias("floor"))
        active = stored(queries.join(floors, "rid", "left").where(
            F.col("floor").isNull() | (F.col("floor") <= 0) | (F.col("length") * longest >= F.col("floor"))), "active")
        if active.isEmpty():
            break
        # the shortest vector that can still matter to a query of the group
        reach = F.when(F.col("floor") > 0, F.col("floor") / F.col("length")).otherwise(0.0)
        need = active.groupBy("g").agg(F.min(reach).alias("need"))
        left = active.select("g", "rid", "x", "floor", F.explode(_numbers(start, stop)).alias("block"))
        right = (ahead.where(F.col("block") < stop).select("*", F.explode(_numbers(0, groups)).alias("g"))
                 .join(need, "g").where(F.col("length") * (1 + _SLACK) >= F.col("need")).drop("need"))
        found = arrow_pairs(left, right, ["g", "block"], kernel, "rid long, score long, vec_id long, other long")
        best = stored(best.drop("rank").unionByName(found).withColumn("rank", F.row_number().over(place))
                      .where(F.col("rank") <= k), "best")
        start, width = stop, width * MORE
    return best.join(queries.select("rid", "query_id"), "rid").select("query_id", "rank", "vec_id", "score")


def _numbers(start: int, stop: int) -> Column:
    return F.sequence(F.lit(start).cast("long"), F.lit(stop - 1).cast("long"))


def top_products_sql(every: int = 20, k: int = 20, scale: int = 64) -> str:
    """DuckDB SQL for the best of ``embeddings``, queries being the ids divisible by ``every``."""
    return f"""
WITH good AS (SELECT row_number() OVER () AS rid, vec_id, [floor({scale} * x::DOUBLE) for x in embedding] AS x
              FROM embeddings WHERE embedding IS NOT NULL
                AND len([x for x in embedding if x IS NULL OR isnan(x) OR isinf(x)]) = 0),
pairs AS (SELECT q.rid, q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
          FROM good q JOIN good c ON q.rid <> c.rid WHERE q.vec_id % {every} = 0)
SELECT query_id, row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id NULLS LAST)::INTEGER AS rank, vec_id, score
FROM pairs QUALIFY rank <= {k}
"""
