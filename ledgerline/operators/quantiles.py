"""Exact quantiles without gathering a column into one task, as one lazy plan.

Equal values are counted first, so a value that a third of all rows have is one row;
every value then knows how many rows come before it (``operators/ranking.py``), and the
order statistics are picked by one aggregate over the values.

Interpolation follows the usual "linear" rule: for quantile q over n sorted
values v, position h = (n - 1) q, result v[floor h] + (h - floor h)(v[ceil h] - v[floor h]).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.ranking import places


def exact_quantiles(df: DataFrame, col: str, qs: dict[str, float]) -> DataFrame:
    """One row: linear-interpolated quantiles of the non-null values of ``col``, named by ``qs`` (NULL without any)."""
    known = df.where(F.col(col).isNotNull()).select(col)
    placed = places(known, col, descending=False).withColumn("_rows", known.agg(F.count(F.lit(1))).scalar())

    def at(rank):
        holds = (F.col("_before") <= rank) & (rank < F.col("_before") + F.col("_n"))
        return F.max(F.when(holds, F.col("_v").cast("double")))

    def position(q):
        return (F.col("_rows") - 1) * F.lit(float(q))

    ends = [e for name, q in qs.items() for e in (
        at(F.floor(position(q))).alias(f"_low_{name}"), at(F.ceil(position(q))).alias(f"_high_{name}"))]
    picked = placed.agg(F.max("_rows").alias("_rows"), *ends)
    return picked.select(*[
        (F.col(f"_low_{name}") + (position(q) - F.floor(position(q))) * (F.col(f"_high_{name}") - F.col(f"_low_{name}")))
        .alias(name) for name, q in qs.items()])
