"""Write raw payment rows as CSV files in the original style (a sink, and a round-trip source).

Files come in two header variants: one with all fourteen columns under upper-case headers padded with spaces, one
without contract number and project code, in reverse order, under title-case headers. Every file
carries its header; text keeps its surrounding spaces; missing values are written as empty cells.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.schema import COLUMN_MAP

# Writer options for the usual CSV quoting rules (doubled quotes inside quoted fields).
_WRITE_OPTIONS = {"header": "true", "encoding": "ISO-8859-1", "quote": '"', "escape": '"',
                  "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def _layouts(raw: DataFrame, short: Column) -> list[DataFrame]:
    """The rows of either header variant under its headers; other columns stay beside them."""
    headers = {canon: text for text, canon in COLUMN_MAP.items()}
    full_cols = [c for c in COLUMN_MAP.values() if c in raw.columns]
    short_cols = [c for c in reversed(full_cols) if c not in ("contract_number", "project_code")]
    extra = [c for c in raw.columns if c.startswith("source")]
    return [raw.where(~short).select(*[F.col(c).alias(f" {headers[c].upper()} ") for c in full_cols], *extra),
            raw.where(short).select(*[F.col(c).alias(headers[c].title()) for c in short_cols], *extra)]


def export_csv(raw: DataFrame, path: str, variant: Column | None = None) -> None:
    """Write ``raw`` (canonical text columns) as CSV files with original-style headers.

    ``variant`` (boolean Column) picks the rows written with the short header.
    """
    for i, df in enumerate(_layouts(raw, variant if variant is not None else F.lit(False))):
        df.write.mode("append" if i else "overwrite").options(**_WRITE_OPTIONS).csv(path)


def dealt_by_month(rows: DataFrame, source: Column, *order: Column) -> DataFrame:
    """``rows`` with the column ``source``, those of each value of it in one task, sorted by ``order``.

    Rows are shuffled here, without ``source`` and ``order``: deal them while they are narrow, then make their texts by
    projections only, as a join would lose the order.
    """
    dealt = rows.repartition(source).withColumns({"source": source} | {f"_order{i}": x for i, x in enumerate(order)})
    by = [f"_order{i}" for i in range(len(order))]
    return dealt.sortWithinPartitions("source", *by).drop(*by)


def export_months(raw: DataFrame, path: str, short: Column) -> None:
    """Write ``raw``, dealt by :func:`dealt_by_month`, as one CSV file for each ``source``, in a folder of its own and compressed.

    ``short`` (true or false for a whole file) picks the files with the short header. A value of ``source`` must not
    hold more rows than a task can write, or read.
    """
    for i, df in enumerate(_layouts(raw, short)):
        df.write.mode("append" if i else "overwrite").partitionBy("source").options(**_WRITE_OPTIONS, compression="gzip").csv(path)
