"""Reporting views and dashboard datasets, as lazy DataFrames.

Views keep money unrounded (exact DECIMAL sums, returned as DOUBLE), as the
stored views they mirror. Each is also registered by :func:`register_views`
under its view name, with row counts reported like a view build log.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators.common import (as_double, by_keys, dim, m_count, m_count_if, m_count_of, m_sum,
                                         one, pct, quarter_number, ratio, when_refund, with_total)
from ledgerline.operators.ranking import with_rank
from ledgerline.operators.reports import _supplier_spend
from ledgerline.operators.warehouse import Tables

c = F.col


def _flows() -> dict:
    """Measures of the money flows, re-summable after a join."""
    a = c("amount")
    return {"n": m_count(), "n_pay": m_count_if(c("is_refund") == 0), "n_ref": m_count_if(c("is_refund") == 1),
            "gross": m_sum(when_refund(a, 0)), "refunds": m_sum(when_refund(a, 1)), "net": m_sum(a),
            "refund_sum": m_sum(c("is_refund"))}


def _by_month(t: Tables, key: str) -> DataFrame:
    """Flows per ``key`` and month, with ``_month`` = year * 100 + month.

    A date key holds its month, so two integers are all that is shuffled; facts without a date have no month and
    are left out.
    """
    month = F.floor(c("date_key") / 100).cast("int")
    return by_keys(t.fact.where(c("date_key").isNotNull()).select(key, "amount", "is_refund", month.alias("_month")),
                   [key, "_month"], _flows())


def _months(t: Tables) -> DataFrame:
    """Calendar attributes, one row per month that occurs."""
    cols = ["year", "month", "month_name", "uk_fiscal_year", "uk_fiscal_quarter", "half_year"]
    return t.dim_date.select((c("year") * 100 + c("month")).alias("_month"), *cols).distinct()


def v1_daily_trend(t: Tables) -> DataFrame:
    """vw_monthly_spend_trend: one row per payment *day* with all date attributes."""
    dd = dim(t.dim_date, "date_key", "full_date", "year", "month", "month_name", "uk_fiscal_year",
             "uk_fiscal_quarter", "half_year")
    keys = ["full_date", "year", "month", "month_name", "uk_fiscal_year", "uk_fiscal_quarter", "half_year"]
    # a date key is one day: its rows are complete after the first aggregation
    return by_keys(t.fact, ["date_key"], _flows()).join(dd, "date_key").select(
        *keys,
        c("n").alias("transaction_count"), as_double(c("gross")).alias("gross_spend"),
        as_double(F.abs(c("refunds"))).alias("total_refunds"), as_double(c("net")).alias("net_spend"),
        c("refund_sum").cast("long").alias("refund_count"))


def v2_supplier_summary(t: Tables) -> DataFrame:
    """vw_supplier_summary: per supplier key; share of the grand total over *all* facts."""
    total = t.fact.agg(F.sum(when_refund(c("amount"), 0)).alias("grand_total"))
    sup = dim(t.dim_supplier, "supplier_key", "supplier_name_raw", "supplier_postcode",
              "supplier_name_clean", "supplier_type")
    g = by_keys(t.fact, ["supplier_key"], _flows()).join(sup, "supplier_key")
    g = with_rank(g.withColumn("grand_total", total.scalar()), "gross", "spend_rank")
    return g.select(
        "supplier_key", "supplier_name_clean", "supplier_type", "supplier_name_raw", "supplier_postcode",
        c("n_pay").alias("payment_count"), c("n_ref").alias("refund_count"),
        as_double(c("gross")).alias("gross_spend"), as_double(F.abs(c("refunds"))).alias("total_refunded"),
        as_double(c("net")).alias("net_spend"), pct(c("gross"), c("grand_total"), 4).alias("pct_of_total"),
        "spend_rank")


def v3_expense_summary(t: Tables) -> DataFrame:
    """vw_expense_summary: expense key x month attributes."""
    exp = dim(t.dim_expense, "expense_key", "expense_type", "expense_area")
    keys = ["expense_key", "expense_type", "expense_area", "uk_fiscal_year", "uk_fiscal_quarter",
            "half_year", "month", "month_name", "year"]
    g = _by_month(t, "expense_key").join(exp, "expense_key").join(_months(t), "_month")
    return g.select(*keys, c("n_pay").alias("transaction_count"), as_double(c("gross")).alias("gross_spend"),
                    as_double(F.abs(c("refunds"))).alias("refunds"), as_double(c("net")).alias("net_spend"))


def v4_entity_monthly(t: Tables) -> DataFrame:
    """vw_entity_monthly: cost centre x month, ranked within the month by gross spend."""
    ent = dim(t.dim_entity, "entity_key", "entity_name", "entity_group", "entity_subgroup")
    keys = ["entity_key", "entity_name", "entity_group", "entity_subgroup", "year", "month", "month_name",
            "uk_fiscal_year", "uk_fiscal_quarter", "half_year"]
    g = _by_month(t, "entity_key").join(ent, "entity_key").join(_months(t), "_month")
    by_month = Window.partitionBy("year", "month").orderBy(c("gross").desc_nulls_last())
    return g.select(*keys, c("n_pay").alias("transaction_count"), as_double(c("gross")).alias("gross_spend"),
                    as_double(c("net")).alias("net_spend"),
                    F.rank().over(by_month).cast("long").alias("monthly_rank"))


def v5_refund_rows(t: Tables) -> DataFrame:
    """vw_refund_analysis: every refund row with supplier, expense and date attributes."""
    f = t.fact.where(c("is_refund") == 1)
    return (f.join(dim(t.dim_supplier, "supplier_key", "supplier_name_clean", "supplier_type"), "supplier_key")
             .join(dim(t.dim_expense, "expense_key", "expense_type", "expense_area"), "expense_key")
             .join(dim(t.dim_date, "date_key", "month_name", "month", "year", "uk_fiscal_quarter"), "date_key")
             .select("supplier_name_clean", "supplier_type", "expense_type", "expense_area", "month_name",
                     "month", "year", "uk_fiscal_quarter", as_double(c("amount")).alias("amount"),
                     "is_refund", "description", "transaction_number"))


def v6_executive_summary(t: Tables) -> DataFrame:
    """vw_executive_summary: fiscal year x quarter x half, over rows with date, supplier and entity.

    The quarter follows from the date key, so measures and both distinct counts are aggregates of their own over
    narrow columns: (quarter, key) pairs are made distinct map-side, and a supplier's names are looked up for
    those pairs only.
    """
    known = t.fact.where(c("date_key").isNotNull() & c("supplier_key").isNotNull() & c("entity_key").isNotNull()) \
        .withColumn("_quarter", quarter_number(c("date_key")))
    quarters = t.dim_date.select(quarter_number(c("date_key")).alias("_quarter"), "uk_fiscal_year", "uk_fiscal_quarter", "half_year").distinct()
    flows = by_keys(known, ["_quarter"], {**_flows(), "n_pay_amount": m_count_of(F.when(c("is_refund") == 0, c("amount")))})

    def distinct(key: str, table: DataFrame, name: str, alias: str) -> DataFrame:
        pairs = known.select("_quarter", key).distinct().join(dim(table, key, name), key)
        return pairs.where(c(name).isNotNull()).select("_quarter", name).distinct().groupBy("_quarter").agg(F.count(one()).alias(alias))

    suppliers = distinct("supplier_key", t.dim_supplier, "supplier_name_clean", "unique_suppliers")
    centres = distinct("entity_key", t.dim_entity, "entity_name", "active_cost_centers")
    g = flows
    for other, how in ((quarters, "inner"), (suppliers, "left"), (centres, "left")):
        g = g.join(F.broadcast(other), "_quarter", how)  # one row a quarter
    g = g.fillna(0, ["unique_suppliers", "active_cost_centers"])
    return g.select(
        "uk_fiscal_year", "uk_fiscal_quarter", "half_year", c("n").alias("total_transactions"),
        "unique_suppliers", "active_cost_centers", as_double(c("gross")).alias("gross_spend"),
        as_double(F.abs(c("refunds"))).alias("total_refunds"), as_double(c("net")).alias("net_spend"),
        c("refund_sum").cast("long").alias("refund_count"), pct(c("refund_sum"), c("n"), 2).alias("refund_rate_pct"),
        ratio(c("gross"), c("n_pay_amount"), 10).alias("avg_transaction_size"))


VIEWS = {
    "vw_monthly_spend_trend": v1_daily_trend,
    "vw_supplier_summary": v2_supplier_summary,
    "vw_expense_summary": v3_expense_summary,
    "vw_entity_monthly": v4_entity_monthly,
    "vw_refund_analysis": v5_refund_rows,
    "vw_executive_summary": v6_executive_summary,
}


def view_rows(t: Tables) -> DataFrame:
    """(view, rows): every view built and counted, as one query."""
    counts = [fn(t).agg(F.count(one()).alias("rows")).select(F.lit(name).alias("view"), "rows") for name, fn in VIEWS.items()]
    return reduce(DataFrame.unionByName, counts)


def register_views(t: Tables, count: bool = False) -> dict[str, int | None]:
    """Create or replace every view as a temp view; optionally count rows (one job each)."""
    counts: dict[str, int | None] = {}
    for name, fn in VIEWS.items():
        df = fn(t)
        df.createOrReplaceTempView(name)
        counts[name] = df.count() if count else None
    return counts


# ------------------------------------------------------------------ dashboard datasets

def d1_kpis(t: Tables) -> DataFrame:
    """KPI cards: net spend, transactions, unique suppliers, refunds issued (count and amount)."""
    totals = t.fact.agg(F.sum("amount").alias("net"), F.count(one()).alias("n"),
                        F.sum("is_refund").alias("refund_count"),
                        F.sum(when_refund(c("amount"), 1)).alias("refunds"))
    sup = (t.fact.where(c("supplier_key").isNotNull()).select("supplier_key").distinct()
                 .join(dim(t.dim_supplier, "supplier_key", "supplier_name_clean"), "supplier_key")
                 .agg(F.count_distinct("supplier_name_clean").alias("unique_suppliers")))
    return totals.withColumn("unique_suppliers", sup.scalar()).select(
        as_double(c("net")).alias("net_spend"), c("n").alias("transaction_count"), "unique_suppliers",
        c("refund_count").cast("long").alias("refunds_issued"),
        as_double(F.abs(c("refunds"))).alias("refund_amount"))


def d2_type_share(t: Tables) -> DataFrame:
    """Non-refund spend share by supplier type."""
    g = with_total(_supplier_spend(t, ["supplier_type"]), "spend")
    return g.select(
        "supplier_type", c("n").alias("transaction_count"), as_double(c("spend")).alias("gross_spend"),
        pct(c("spend"), c("grand_total"), 2).alias("pct_of_total"))


def d3_top10(t: Tables, top: int = 10) -> DataFrame:
    """Top suppliers by non-refund (gross) spend."""
    g = _supplier_spend(t, ["supplier_name_clean"])
    return (g.orderBy(c("spend").desc_nulls_last(), c("supplier_name_clean").asc_nulls_first()).limit(top)
             .select("supplier_name_clean", c("n").alias("transaction_count"),
                     as_double(c("spend")).alias("gross_spend")))


def d5_topn_share(t: Tables, n: int = 5) -> DataFrame:
    """Share of total non-refund spend held by suppliers ranked <= n (ties included)."""
    spend = with_total(_supplier_spend(t, ["supplier_name_clean"]), "spend")
    ranked = spend.withColumn("rnk", F.rank().over(Window.orderBy(c("spend").desc_nulls_last())))
    top = ranked.where(c("rnk") <= n).agg(F.count(one()).alias("suppliers"), F.sum("spend").alias("top_spend"),
                                          F.max("grand_total").alias("grand_total"))
    return top.select(
        F.lit(n).alias("top_n"), "suppliers", as_double(c("top_spend")).alias("top_spend"),
        as_double(c("grand_total")).alias("grand_total"), pct(c("top_spend"), c("grand_total"), 2).alias("pct_of_total"))


DATASETS = {"d1_kpis": d1_kpis, "d2_type_share": d2_type_share, "d3_top10": d3_top10,
            "d5_topn_share": d5_topn_share}
