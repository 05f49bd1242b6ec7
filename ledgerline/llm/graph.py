"""Connected components of an edge table by alternating large-star and small-star steps.

Each step is a grouped minimum and a join, so a node with very many neighbours is
pre-aggregated before the shuffle and never gathered into one group. Every round is
stored in the shared folder, which cuts the lineage; only two numbers a round
(edge count and checksum) reach the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import stored


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node that each node of ``edges`` (a long, b long) is joined with.

    Self-loops, repeated and reversed edges count once; edges with a null end are
    ignored; an empty table gives an empty table.
    """
    pair = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).where("u <> v")
    now = stored(pair.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "cc")
    state = _state(now)
    while state[0]:
        both = now.select("u", "v").unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # minima are stored before each join, so that both sides are plain shuffles, whose hot nodes Spark can split
        low = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "cc-low")
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = stored(large.where("u <> v").distinct(), "cc-large")
        small = stored(large.groupBy("u").agg(F.min("v").alias("m")), "cc-small")
        linked = large.join(small, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        after = stored(linked.unionAll(small.select("u", F.col("m").alias("v"))).distinct(), "cc")
        new_state = _state(after)
        now, state, last = after, new_state, state
        if new_state == last:
            break
    tops = now.select(F.col("v").alias("node")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionAll(
        tops.select("node", F.col("node").alias("root")))
