"""Data profiling of payment rows (shape, nulls, distinct values, amounts, duplicates).

Every profile is one or two distributed aggregations over the whole input;
results are small (one row per column, per file or per top value). Column
lookup by name fragment mirrors how the profiling found its columns
("the first column whose name contains 'amount'").
"""

from __future__ import annotations


from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.common import one, ratio
from ledgerline.operators.quantiles import exact_quantiles
from ledgerline.plans.materialize import new_location, sent_whole, write_table

c = F.col


def find_column(df: DataFrame, *fragments: str) -> str:
    """First column whose lower-case name contains any of the fragments."""
    for name in df.columns:
        if any(f in name.lower() for f in fragments):
            return name
    raise KeyError(f"no column matching {fragments}")


def shape(df: DataFrame, by: str = "_source_file") -> DataFrame:
    """Rows per file and the number of columns."""
    return df.groupBy(c(by).alias("file")).agg(F.count(one()).alias("rows")).withColumn(
        "columns", F.lit(len(df.columns)))


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: NULL count and NULL share in percent (1 decimal)."""
    cols = cols or df.columns
    agg = df.agg(F.count(one()).alias("_rows"), *[F.count_if(c(x).isNull()).alias(x) for x in cols])
    long = agg.unpivot(["_rows"], cols, "column_name", "null_count")
    return long.select("column_name", "null_count", ratio(c("null_count"), c("_rows"), 1, 100.0).alias("null_pct"))


def distinct_counts(df: DataFrame, cols: list[str]) -> DataFrame:
    """Per column: number of distinct non-NULL values (two-level aggregate on (column, value))."""
    long = df.select(*[c(x).cast("string").alias(x) for x in cols]).unpivot([], cols, "column_name", "value")
    return long.where(c("value").isNotNull()).groupBy("column_name").agg(F.count_distinct("value").alias("distinct"))


def value_counts(df: DataFrame, cols: list[str], top: int = 10) -> DataFrame:
    """Per column: the ``top`` most frequent non-NULL values (ties by value)."""
    long = df.select(*[c(x).cast("string").alias(x) for x in cols]).unpivot([], cols, "column_name", "value")
    counts = long.where(c("value").isNotNull()).groupBy("column_name", "value").agg(F.count(one()).alias("count"))
    rank = F.row_number().over(Window.partitionBy("column_name").orderBy(c("count").desc(), c("value")))
    return counts.withColumn("pos", rank).where(c("pos") <= top).drop("pos")


def sign_counts(df: DataFrame, col: str = "amount") -> DataFrame:
    """Negative (refund), zero, positive and NULL amounts, with gross, refund and net totals."""
    x = c(col)
    return df.agg(
        F.count_if(x < 0).alias("negative"), F.count_if(x == 0).alias("zero"),
        F.count_if(x > 0).alias("positive"), F.count_if(x.isNull()).alias("null"),
        F.sum(F.when(x > 0, x)).cast("double").alias("gross"),
        F.sum(F.when(x < 0, x)).cast("double").alias("refunds"), F.sum(x).cast("double").alias("net"))


def describe(df: DataFrame, col: str = "amount") -> DataFrame:
    """count, mean, sample std, min, 25/50/75 % (exact, linear), max of a money column, as one lazy plan."""
    x = c(col)
    r4 = lambda e: F.round(e.cast("decimal(38,10)"), 4).cast("double")
    whole = df.agg(F.count(x).alias("count"), F.sum(x).alias("s1"), F.stddev_samp(x.cast("double")).alias("std"),
                   F.min(x).cast("double").alias("min"), F.max(x).cast("double").alias("max"))
    parts = exact_quantiles(df, col, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return whole.join(F.broadcast(parts)).select(  # one row each
        "count", ratio(c("s1"), c("count"), 4).alias("mean"), r4(c("std")).alias("std"), "min",
        *[r4(c(q)).alias(q) for q in ("p25", "p50", "p75")], "max")


def top_groups(df: DataFrame, key: str, value: str = "amount", top: int = 10) -> DataFrame:
    """Keys with the largest sum of ``value`` (NULL keys excluded)."""
    g = df.where(c(key).isNotNull()).groupBy(key).agg(F.sum(value).alias("total"))
    return (g.orderBy(c("total").desc_nulls_last(), c(key).asc()).limit(top)
             .select(key, c("total").cast("double").alias("total")))


def duplicate_counts(df: DataFrame, cols: list[str], key: str) -> DataFrame:
    """Rows beyond the first of each identical row, and of each repeated ``key`` value.

    Rows are told apart by 128-bit fingerprints, so two numbers a row are shuffled and not all its cells. Only
    rows whose fingerprint occurs again are then grouped by their cells, which makes the count exact. Those fingerprints
    are stored first: their number tells whether they are sent to the rows or the rows are shuffled to them.
    """
    nulls = F.concat(*[F.when(c(x).isNull(), "1").otherwise("0") for x in cols])  # hashing passes over NULL
    prints = {"_f1": F.xxhash64(nulls, *[c(x) for x in cols]), "_f2": F.xxhash64(F.lit(1), nulls, *[c(x) for x in cols])}
    rows = df.select(*cols, *[x.alias(n) for n, x in prints.items()])
    again = rows.groupBy(*prints).agg(F.count(one()).alias("_k")).where(c("_k") > 1).select(*prints)
    again = sent_whole(write_table(again, new_location(df.sparkSession, "repeated-prints")))
    full = (rows.join(again, list(prints), "left_semi").groupBy(*cols).agg(F.count(one()).alias("_k"))
                .agg(F.coalesce(F.sum(c("_k") - 1), F.lit(0)).alias("duplicate_rows")))
    keyed = df.groupBy(key).agg(F.count(one()).alias("_k")).agg(F.sum(c("_k") - 1).alias("duplicate_keys"))
    return full.withColumn("duplicate_keys", keyed.scalar())  # two one-row aggregates


def duplicate_members(df: DataFrame, key: str, cols: list[str], top: int = 8, order: str = "row_id") -> DataFrame:
    """All rows whose ``key`` occurs more than once (first ``top`` by key, ``order``, then ``cols``).

    A repeated key has two rows at least, so the first ``top`` rows lie within the ``top`` smallest repeated keys:
    a few keys to look up, not a join of the whole table with itself.
    """
    dup = df.groupBy(key).agg(F.count(one()).alias("_k")).where(c("_k") > 1)
    first = F.broadcast(dup.orderBy(c(key).asc_nulls_first()).limit(top).select(c(key).alias("_dup")))  # `top` rows
    rows = df.join(first, df[key].eqNullSafe(first["_dup"]), "left_semi").select(key, order, *cols)
    return rows.orderBy(key, order, *cols).limit(top)  # every column breaks ties: a total order


def date_range(df: DataFrame, col: str = "payment_date") -> DataFrame:
    return df.agg(F.min(col).alias("min_date"), F.max(col).alias("max_date"),
                  F.count_if(c(col).isNull()).alias("null_dates"))


def dtypes(df: DataFrame) -> DataFrame:
    """Column names and types (schema metadata: one row per column)."""
    rows = [(i, name, typ) for i, (name, typ) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "ordinal int, column_name string, data_type string")
