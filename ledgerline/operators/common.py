"""Small Column helpers shared by reports, views and checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def one() -> Column:
    """Literal 1 (built lazily: no Spark context is needed at import time)."""
    return F.lit(1)


def money(c: Column) -> Column:
    """Exact DECIMAL money rounded half-up to pence, returned as DOUBLE."""
    return F.round(c, 2).cast("double")


def as_double(c: Column) -> Column:
    return c.cast("double")


def ratio(num: Column, den: Column, digits: int, scale: float = 1.0) -> Column:
    """``round(scale * num / den, digits)``; NULL when ``den`` is 0 or NULL.

    Computed as one IEEE double division, then rounded half-up through
    DECIMAL(38,10), so the result is reproducible in any SQL engine.
    """
    q = (F.lit(scale) * num.cast("double")) / F.nullif(den.cast("double"), F.lit(0.0))
    return F.round(q.cast("decimal(38,10)"), digits).cast("double")


def pct(num: Column, den: Column, digits: int) -> Column:
    return ratio(num, den, digits, 100.0)


def when_refund(c: Column, refund: int) -> Column:
    """``CASE WHEN is_refund = refund THEN c ELSE 0 END``."""
    return F.when(F.col("is_refund") == refund, c).otherwise(F.lit(0))


def dim(df: DataFrame, *cols: str) -> DataFrame:
    """The needed columns of a dimension; the planner and adaptive execution choose how it is joined."""
    return df.select(*cols)


def formatted(df: DataFrame, money_cols: list[str], digits: int = 2) -> DataFrame:
    """Display copy with thousands separators on money columns (presentation only)."""
    return df.withColumns({m: F.format_number(F.col(m), digits) for m in money_cols})


def quarter_number(date_key: Column) -> Column:
    """A number for the fiscal quarter of a date key (year, month, day): whole quarters since year 0."""
    month = F.floor(date_key / 100)
    return F.floor((F.floor(month / 100) * 12 + month % 100 - 1) / 3).cast("int")


# ---------------------------------------------------------------- eager aggregation
# A measure is (aggregate over a key group, equivalent value of a single row).
# Re-summing either form with F.sum / F.max gives the same result.

def m_count() -> tuple[Column, Column]:
    return F.count(F.lit(1)), F.lit(1).cast("long")


def m_sum(x: Column) -> tuple[Column, Column]:
    return F.sum(x), x


def m_count_of(x: Column) -> tuple[Column, Column]:
    return F.count(x), F.when(x.isNotNull(), F.lit(1)).otherwise(F.lit(0)).cast("long")


def m_count_if(cond: Column) -> tuple[Column, Column]:
    return F.count_if(cond), F.coalesce(cond, F.lit(False)).cast("long")


def m_max(x: Column) -> tuple[Column, Column]:
    return F.max(x), x


def by_keys(fact: DataFrame, keys: list[str], measures: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Fact measures per dimension-key combination, ready to join to the dimensions.

    The fact is aggregated on the keys first (combined map-side), so a join sees one row
    per key combination instead of one per transaction, and a hot key is one row.
    """
    return fact.groupBy(*keys).agg(*[agg.alias(n) for n, (agg, _) in measures.items()])


def with_total(g: DataFrame, col: str, name: str = "grand_total") -> DataFrame:
    """``g`` plus the sum of ``col`` over all its rows, as a scalar subquery (one row, no window over all groups)."""
    return g.withColumn(name, g.agg(F.sum(col)).scalar())
