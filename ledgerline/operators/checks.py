"""Load and warehouse checks: row counts, unresolved keys, control totals, per-file quality."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.common import as_double, by_keys, dim, m_count, m_sum, money, one
from ledgerline.operators.warehouse import Tables
from ledgerline.schema import ROUNDED_AMOUNT, UNPARSED_AMOUNT, UNPARSED_DATE

c = F.col
KEYS = ("date_key", "supplier_key", "expense_key", "entity_key")


def k1_warehouse_counts(t: Tables) -> DataFrame:
    """Row counts of the five tables, NULL date / supplier / expense keys and refund rows."""
    fact = t.fact.agg(
        F.count(one()).alias("fact_rows"),
        F.count_if(c("date_key").isNull()).alias("null_date_keys"),
        F.count_if(c("supplier_key").isNull()).alias("null_supplier_keys"),
        F.count_if(c("expense_key").isNull()).alias("null_expense_keys"),
        F.count_if(c("is_refund") == 1).alias("refund_rows"))
    out = fact
    for name in ("dim_date", "dim_supplier", "dim_expense", "dim_entity"):
        out = out.withColumn(f"{name}_rows", getattr(t, name).agg(F.count(one())).scalar())
    return out.select("fact_rows", "dim_date_rows", "dim_supplier_rows", "dim_expense_rows",
                      "dim_entity_rows", "null_date_keys", "null_supplier_keys", "null_expense_keys",
                      "refund_rows")


def k2_unresolved_keys(t: Tables) -> DataFrame:
    """Fact rows whose dimension key did not resolve, per key (warn when > 0)."""
    return t.fact.agg(*[F.count_if(c(k).isNull()).alias(f"null_{k}s") for k in KEYS])


def k3_top5_net(t: Tables, top: int = 5) -> DataFrame:
    """Top suppliers by *net* spend (refunds included)."""
    sup = dim(t.dim_supplier, "supplier_key", "supplier_name_clean")
    per_key = by_keys(t.fact, ["supplier_key"], {"net": m_sum(c("amount")), "n": m_count()})
    g = (per_key.join(sup, "supplier_key")
                .groupBy("supplier_name_clean").agg(F.sum("net").alias("net"), F.sum("n").alias("n")))
    return (g.orderBy(c("net").desc_nulls_last(), c("supplier_name_clean").asc_nulls_first()).limit(top)
             .select("supplier_name_clean", money(c("net")).alias("net_spend"), c("n").alias("transactions")))


def k4_quarter_net(t: Tables) -> DataFrame:
    """Transactions and net spend per fiscal year and quarter."""
    dd = dim(t.dim_date, "date_key", "uk_fiscal_year", "uk_fiscal_quarter")
    per_key = by_keys(t.fact, ["date_key"], {"n": m_count(), "net": m_sum(c("amount"))})
    g = (per_key.join(dd, "date_key")
                .groupBy("uk_fiscal_year", "uk_fiscal_quarter")
                .agg(F.sum("n").alias("transactions"), F.sum("net").alias("net")))
    return g.select("uk_fiscal_year", "uk_fiscal_quarter", "transactions",
                    money(c("net")).alias("net_spend")).orderBy("uk_fiscal_year", "uk_fiscal_quarter")


def k5_load_totals(staging: DataFrame) -> DataFrame:
    """Staging control totals: rows, non-refund (gross) spend, refund rows."""
    return staging.agg(
        F.count(one()).alias("rows"),
        as_double(F.sum(F.when(~c("is_refund"), c("amount")))).alias("gross_spend"),
        F.count_if(c("is_refund")).alias("refund_rows"))


def k6_load_quality(staging: DataFrame, raw_counts: DataFrame | None = None, added: DataFrame | None = None) -> DataFrame:
    """Per source file: raw and clean rows, blank rows dropped, refunds, missing, unparseable and rounded amounts,
    missing and unparseable dates, columns added and net spend.

    What cleaning did to the cells was noted during the load (``_flags``) and is only added up here. ``raw_counts`` holds
    (``_source_file``, ``raw_rows``) counted before blank rows were dropped, also of files without any clean
    row; without it every staged row counts as a raw row. ``added`` holds (``file``, ``columns_added``); without
    it that column is left out.
    """
    def flagged(bit: int):
        return F.count_if(c("_flags").bitwiseAND(bit) != 0)

    counts = {"clean_rows": F.count(one()), "refunds": F.count_if(c("is_refund")),
              "null_amounts": F.count_if(c("amount").isNull()), "unparsed_amounts": flagged(UNPARSED_AMOUNT),
              "rounded_amounts": flagged(ROUNDED_AMOUNT), "bad_dates": F.count_if(c("payment_date").isNull()),
              "unparsed_dates": flagged(UNPARSED_DATE)}
    g = staging.groupBy("_source_file").agg(*[x.alias(n) for n, x in counts.items()], F.sum("amount").alias("net"))
    if raw_counts is not None:
        g = raw_counts.select("_source_file", "raw_rows").join(g, "_source_file", "left").fillna(0, list(counts))
    else:
        g = g.withColumn("raw_rows", c("clean_rows"))
    extra = []
    if added is not None:
        g, extra = g.join(added.withColumnRenamed("file", "_source_file"), "_source_file", "left"), ["columns_added"]
    return g.select(c("_source_file").alias("file"), "raw_rows", "clean_rows",
                    (c("raw_rows") - c("clean_rows")).alias("dropped"), *list(counts)[1:], *extra,
                    as_double(c("net")).alias("total_net_spend")).orderBy("file")


def warnings(t: Tables) -> list[str]:
    """Warnings for unresolved keys (one small aggregate job)."""
    row = k2_unresolved_keys(t).first()
    return [f"{row[f'null_{k}s']} rows with NULL {k}" for k in KEYS if row[f"null_{k}s"]]


CHECKS = {"k1_warehouse_counts": k1_warehouse_counts, "k2_unresolved_keys": k2_unresolved_keys,
          "k3_top5_net": k3_top5_net, "k4_quarter_net": k4_quarter_net}
