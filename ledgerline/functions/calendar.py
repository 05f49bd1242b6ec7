"""UK fiscal calendar as native Column expressions (no Python per row).

The UK fiscal year runs April to March: 2015-04-01 .. 2016-03-31 is FY2015/16.
Shifting a date back three months turns fiscal arithmetic into calendar
arithmetic: the shifted year is the fiscal start year and the shifted
calendar quarter is the fiscal quarter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _shifted(d: Column) -> Column:
    return F.add_months(d, -3)


def fiscal_year(d: Column) -> Column:
    """``FY{start}/{end mod 100, two digits}``; NULL date -> NULL."""
    start = F.year(_shifted(d))
    return F.concat(F.lit("FY"), start.cast("string"), F.lit("/"),
                    F.lpad(((start + 1) % 100).cast("string"), 2, "0"))


def fiscal_quarter(d: Column) -> Column:
    """Q1 = Apr-Jun, Q2 = Jul-Sep, Q3 = Oct-Dec, Q4 = Jan-Mar."""
    return F.concat(F.lit("Q"), F.quarter(_shifted(d)).cast("string"))


def half_year(month: Column) -> Column:
    """H1 = April..September, H2 otherwise (a NULL month falls to H2, as in the source)."""
    return F.when(month.between(4, 9), F.lit("H1")).otherwise(F.lit("H2"))


def quarter_name(d: Column) -> Column:
    """Calendar quarter label Q1..Q4."""
    return F.concat(F.lit("Q"), F.quarter(d).cast("string"))


def month_name(d: Column) -> Column:
    """English month name (April, May, ...)."""
    return F.date_format(d, "MMMM")


def date_key(d: Column) -> Column:
    """Integer YYYYMMDD."""
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")
