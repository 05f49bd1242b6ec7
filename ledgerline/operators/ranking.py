"""Places of values among all values without funnelling every row through one task, one lazy plan at every size.

A window with an ORDER BY but no PARTITION BY sorts all rows in a single task. Here equal values are counted first
(a hot tie becomes one row). Borders are then taken from the distinct values themselves, as approximate quantiles,
which cut them into slots of about equal size however close the values lie; the slots are dealt to
tasks by range. What comes before a value is the sum of the slots before its own (a window over the slots: their number
is a multiple of the shuffle partitions) and the sum before it in its slot (a window per slot).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Slots per shuffle partition.
SLOTS = 4


def slot_of(value: Column, borders: Column, count: int) -> Column:
    """How many of ``count`` rising ``borders`` lie below ``value``, by binary search; NULL is in the last slot."""
    steps = [1 << k for k in reversed(range(count.bit_length()))]
    found = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), lambda at, step: F.when(
        (at + step <= count) & (F.get(borders, at + step - 1) < value), at + step).otherwise(at))
    return F.when(value.isNull(), F.lit(count + 1)).otherwise(found)


def before(df: DataFrame, value: str, weight: str | None = None, descending: bool = False) -> DataFrame:
    """``df`` plus ``_before``: the sum of ``weight`` (default: the number) of the rows that come before a row.

    The values of ``df`` must be distinct; NULL comes last.
    """
    count = SLOTS * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) - 1
    shares = F.array(*[F.lit((k + 1) / (count + 1)) for k in range(count)])
    borders = df.agg(F.percentile_approx(value, shares, 50 * (count + 1)).alias("b"))
    w = F.lit(1).cast("long") if weight is None else F.col(weight)
    slot = slot_of(F.col(value), F.col("_borders"), count)
    slotted = df.withColumns({"_w": w, "_borders": borders.scalar()}).withColumn("_slot", F.when(F.col(value).isNotNull(), F.lit(count) - slot).otherwise(slot)
                                                if descending else slot).drop("_borders")

    def earlier(window):
        return window.rowsBetween(Window.unboundedPreceding, -1)

    slots = slotted.groupBy(F.col("_slot").alias("_s")).agg(F.sum("_w").alias("_m"))
    slots = slots.withColumn("_earlier", F.coalesce(F.sum("_m").over(earlier(Window.orderBy("_s"))), F.lit(0))).drop("_m")
    order = F.col(value).desc_nulls_last() if descending else F.col(value).asc_nulls_last()
    inside = F.coalesce(F.sum("_w").over(earlier(Window.partitionBy("_slot").orderBy(order))), F.lit(0))
    placed = slotted.repartitionByRange(F.col("_slot")).withColumn("_inside", inside)
    return placed.join(F.broadcast(slots), F.col("_slot") == F.col("_s")).withColumn(  # a row a slot
        "_before", (F.col("_earlier") + F.col("_inside")).cast("long")).drop("_w", "_slot", "_s", "_inside", "_earlier")


def places(df: DataFrame, value: str, descending: bool = True) -> DataFrame:
    """(_v, _n, _before): every value of ``df``, how many rows have it and how many come before them, NULL last."""
    counts = df.groupBy(F.col(value).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    return before(counts, "_v", "_n", descending).select("_v", "_n", "_before")


def with_rank(df: DataFrame, value: str, name: str = "rank", descending: bool = True) -> DataFrame:
    """``df`` plus ``name`` = RANK() OVER (ORDER BY value [DESC] NULLS LAST)."""
    ranks = places(df, value, descending).select("_v", (F.col("_before") + 1).alias(name))
    return df.join(ranks, F.col(value).eqNullSafe(F.col("_v"))).drop("_v")
