"""Raw payment rows -> cleaned staging rows (one projection, fused by codegen)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import (fiscal_quarter, fiscal_year, is_rounded, month_name, normalize_supplier,
                                  null_tokens, parse_amount, parse_uk_date, refund_flag, strip_ws,
                                  title_case)
from ledgerline.schema import (CANONICAL_COLS, CORE_COLS, ORDER_COLS, ROUNDED_AMOUNT, STAGING_COLS, UNPARSED_AMOUNT,
                               UNPARSED_DATE)


def add_missing_columns(df: DataFrame) -> DataFrame:
    """Schema reconciliation: every canonical column missing from ``df`` becomes NULL text."""
    missing = {c: F.lit(None).cast("string") for c in CANONICAL_COLS if c not in df.columns}
    return df.withColumns(missing) if missing else df


def apply_null_tokens(df: DataFrame, cols=None) -> DataFrame:
    cols = [c for c in (cols or CANONICAL_COLS) if c in df.columns]
    return df.withColumns({c: null_tokens(F.col(c)) for c in cols})


def drop_blank_rows(df: DataFrame) -> DataFrame:
    """Drop rows whose core fields (those present) are all NULL; whitespace is not NULL."""
    present = [c for c in CORE_COLS if c in df.columns]
    if not present:
        return df.limit(0)
    return df.where(reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in present]))


def clean(raw: DataFrame) -> DataFrame:
    """Apply the cleaning rules to raw text rows and project the staging layout.

    ``raw`` holds canonical text columns (any subset), ``_source_file`` and
    ``_row_idx``; null tokens must already be NULL and blank rows dropped.
    ``_row_key`` is added when absent (unique per row within this plan). ``_flags`` tells what cleaning did to
    the row's cells, for the load's counters.
    """
    df = add_missing_columns(raw)
    if "_row_key" not in df.columns:
        df = df.withColumn("_row_key", F.monotonically_increasing_id())
    if "_load_timestamp" not in df.columns:
        df = df.withColumn("_load_timestamp", F.current_timestamp())
    amount = parse_amount(F.col("amount"))
    pay = parse_uk_date(F.col("payment_date"))
    flags = {UNPARSED_AMOUNT: F.col("amount").isNotNull() & amount.isNull(),
             UNPARSED_DATE: F.col("payment_date").isNotNull() & pay.isNull(), ROUNDED_AMOUNT: is_rounded(F.col("amount"))}
    df = df.withColumns({"amount": amount, "payment_date": pay,
                         "_flags": sum((F.when(on, F.lit(bit)).otherwise(0) for bit, on in flags.items()), F.lit(0))})
    d = F.col("payment_date")
    df = df.withColumns({
        "payment_year": F.year(d),
        "payment_month": F.month(d),
        "payment_month_name": month_name(d),
        "uk_fiscal_year": fiscal_year(d),
        "uk_fiscal_quarter": fiscal_quarter(d),
        "is_refund": refund_flag(F.col("amount")),
        "supplier_name_clean": normalize_supplier(F.col("supplier_name")),
        "expense_type": title_case(F.col("expense_type")),
        "expense_area": strip_ws(F.col("expense_area")),
        "row_id": F.concat(F.replace(F.col("_source_file"), F.lit(".csv"), F.lit("")),
                           F.lit("_"), F.col("_row_idx").cast("string")),
    })
    return df.select(*STAGING_COLS, *ORDER_COLS)
