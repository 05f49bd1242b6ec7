"""The analytical reports, each a function ``(tables, **params) -> DataFrame``.

Plan shape used throughout: the fact is first aggregated on the dimension
keys the report needs (partial + final hash aggregate, so a hot key costs one
row per map task), the much smaller result is joined to the dimensions, and
only then grouped by the dimension attributes. Global windows (rank, running
totals, month-on-month) run on these small aggregates; totals are scalar
subqueries, so ``rank <= k`` filters get a partial
window-group limit and only the top rows reach a single partition.
"""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions import half_year
from ledgerline.operators.common import (as_double, by_keys, dim, formatted, m_count, m_count_if, m_count_of, m_max,
                                         m_sum, money, pct, quarter_number, ratio, when_refund, with_total)
from ledgerline.operators.ranking import with_rank
from ledgerline.operators.warehouse import Tables

c = F.col

# Half-year budget pattern labels (the analytical-query form,
# then the short form of the report runner).
PATTERN_LABELS = ("⚠ High H2 Spike", "↑ Moderate H2 Increase", "↓ H2 Drop", "~ Balanced")
PATTERN_LABELS_SHORT = ("H2 SPIKE", "H2 High", "H2 Low", "Balanced")
# Refund risk and monthly anomaly labels.
RISK_LABELS = ("HIGH RISK", "MODERATE", "NORMAL")
ANOMALY_LABELS = ("SPIKE", "LOW", "Normal")


def _non_refund(t: Tables) -> DataFrame:
    return t.fact.where(c("is_refund") == 0)


def _dated(t: Tables) -> DataFrame:
    """Facts with a date: a date key is year, month and day, so calendar attributes follow from it without a join."""
    return t.fact.where(c("date_key").isNotNull())


def _month_of() -> Column:
    return F.floor(c("date_key") / 100).cast("int") % 100


def _quarter_label() -> Column:
    return F.concat(F.lit("Q"), (F.floor((_month_of() + 8) % 12 / 3) + 1).cast("string"))


def _supplier_spend(t: Tables, by: list[str]) -> DataFrame:
    """Non-refund count and spend per supplier attribute set ``by``."""
    sup = dim(t.dim_supplier, "supplier_key", *sorted(set(by)))
    per_key = by_keys(_non_refund(t), ["supplier_key"], {"n": m_count(), "spend": m_sum(c("amount"))})
    return per_key.join(sup, "supplier_key").groupBy(*by).agg(
        F.sum("n").alias("n"), F.sum("spend").alias("spend"))


# --------------------------------------------------------------------- use case 1

def q1a_top_suppliers(t: Tables, limit: int | None = 25) -> DataFrame:
    """1A: suppliers ranked by non-refund spend, with share of total and rank."""
    g = _supplier_spend(t, ["supplier_name_clean", "supplier_type"])
    # refunds are summed under the non-refund filter, as specified (always 0)
    g = g.withColumn("refunds", F.lit(0).cast("decimal(28,2)"))
    order = [c("spend").desc_nulls_last(), c("supplier_name_clean").asc_nulls_first(),
             c("supplier_type").asc_nulls_first()]
    # with a limit the rank is computed on these few rows (it depends only on the
    # rows above); without one, over all suppliers, distributed
    g = with_total(g, "spend")
    top = g.orderBy(*order).limit(limit) if limit else g
    by_spend = Window.orderBy(c("spend").desc_nulls_last())
    ranked = (top.withColumn("spend_rank", F.rank().over(by_spend).cast("long")) if limit
              else with_rank(top, "spend", "spend_rank"))
    out = ranked.select(
        "supplier_name_clean", "supplier_type",
        c("n").alias("transaction_count"),
        as_double(c("spend")).alias("gross_spend"),
        as_double(c("refunds")).alias("total_refunds"),
        as_double(c("spend") - F.abs(c("refunds"))).alias("net_spend"),
        pct(c("spend"), c("grand_total"), 2).alias("pct_of_total_spend"), "spend_rank",
    )
    return out.orderBy(c("gross_spend").desc_nulls_last(), "supplier_name_clean", "supplier_type")


def q1b_concentration(t: Tables, max_rank: int = 25) -> DataFrame:
    """1B: supplier concentration: rank, share and cumulative share for rank <= max_rank."""
    spend = with_total(_supplier_spend(t, ["supplier_name_clean"]).select("supplier_name_clean", "spend"),
                       "spend")
    ranked = spend.withColumn("rnk", F.rank().over(Window.orderBy(c("spend").desc_nulls_last())))
    top = ranked.where(c("rnk") <= max_rank)
    running = F.sum("spend").over(
        Window.orderBy("rnk").rangeBetween(Window.unboundedPreceding, Window.currentRow))
    return top.select(
        c("rnk").cast("long").alias("supplier_rank"), "supplier_name_clean",
        money(c("spend")).alias("spend"),
        pct(c("spend"), c("grand_total"), 2).alias("pct_of_total"),
        pct(running, c("grand_total"), 2).alias("cumulative_pct"),
    ).orderBy("supplier_rank", "supplier_name_clean")


def q1c_supplier_quarter(t: Tables, top: int = 10) -> DataFrame:
    """1C: spend per fiscal quarter label for the top suppliers."""
    leaders = (_supplier_spend(t, ["supplier_name_clean"])
               .orderBy(c("spend").desc_nulls_last(), c("supplier_name_clean").asc_nulls_first())
               .limit(top).select("supplier_name_clean"))
    sup = dim(t.dim_supplier, "supplier_key", "supplier_name_clean").join(
        F.broadcast(leaders), "supplier_name_clean", "left_semi")  # `top` rows: bounded
    # a supplier's four quarters over all years are all that is shuffled
    per_key = by_keys(_dated(t).where(c("is_refund") == 0).withColumn("uk_fiscal_quarter", _quarter_label()),
                      ["supplier_key", "uk_fiscal_quarter"], {"n": m_count(), "spend": m_sum(c("amount"))})
    rows = per_key.join(sup, "supplier_key")
    return rows.groupBy("supplier_name_clean", "uk_fiscal_quarter").agg(
        F.sum("n").alias("transactions"), money(F.sum("spend")).alias("quarterly_spend"),
    ).orderBy("supplier_name_clean", "uk_fiscal_quarter")


# --------------------------------------------------------------------- use case 2

def _expense_key_totals(t: Tables, exp: DataFrame) -> DataFrame:
    a = c("amount")
    return by_keys(_non_refund(t), ["expense_key"], {"n": m_count(), "spend": m_sum(a),
                                                      "n_amount": m_count_of(a), "largest": m_max(a)})


def q2a_expense_types(t: Tables, limit: int | None = 20) -> DataFrame:
    """2A: spend by expense type (non-null types), with average, largest and share."""
    exp = dim(t.dim_expense.where(c("expense_type").isNotNull()), "expense_key", "expense_type")
    g = _expense_key_totals(t, exp).join(exp, "expense_key").groupBy("expense_type").agg(
        F.sum("n").alias("n"), F.sum("spend").alias("spend"),
        F.sum("n_amount").alias("n_amount"), F.max("largest").alias("largest"))
    order = [c("spend").desc_nulls_last(), c("expense_type").asc_nulls_first()]
    g = with_total(g, "spend")
    top = g.orderBy(*order).limit(limit) if limit else g
    return top.select(
        "expense_type", c("n").alias("transaction_count"),
        money(c("spend")).alias("total_spend"),
        ratio(c("spend"), c("n_amount"), 2).alias("avg_transaction"),
        money(c("largest")).alias("largest_transaction"),
        pct(c("spend"), c("grand_total"), 2).alias("pct_of_total"),
    ).orderBy(c("total_spend").desc_nulls_last(), "expense_type")


def _half_year_pivot(t: Tables) -> DataFrame:
    exp = dim(t.dim_expense.where(c("expense_type").isNotNull()), "expense_key", "expense_type")
    first = half_year(_month_of()) == "H1"
    # both halves are sums beside each other: one row a key is shuffled
    per_key = by_keys(_dated(t).where(c("is_refund") == 0), ["expense_key"], {
        "h1": m_sum(F.when(first, c("amount")).otherwise(F.lit(0))),
        "h2": m_sum(F.when(~first, c("amount")).otherwise(F.lit(0)))})
    return per_key.join(exp, "expense_key").groupBy("expense_type").agg(F.sum("h1").alias("h1"), F.sum("h2").alias("h2"))


def _pattern(labels: tuple[str, str, str, str]):
    h1, h2 = c("h1"), c("h2")
    k = {x: F.lit(Decimal(x)) for x in ("1.5", "1.2", "0.8")}  # exact decimal thresholds
    return (F.when(h2 > h1 * k["1.5"], labels[0]).when(h2 > h1 * k["1.2"], labels[1])
             .when(h2 < h1 * k["0.8"], labels[2]).otherwise(labels[3]))


def q2b_half_year_pattern(t: Tables, limit: int | None = 20,
                          labels: tuple[str, str, str, str] = PATTERN_LABELS) -> DataFrame:
    """2B: H1 vs H2 spend per expense type with growth and budget pattern."""
    p = _half_year_pivot(t).where((c("h1") + c("h2")) > 0)
    order = [(c("h1") + c("h2")).desc_nulls_last(), c("expense_type").asc_nulls_first()]
    top = p.orderBy(*order).limit(limit) if limit else p
    return top.select(
        "expense_type", money(c("h1")).alias("h1_spend"), money(c("h2")).alias("h2_spend"),
        money(c("h1") + c("h2")).alias("annual_spend"),
        money(c("h2") - c("h1")).alias("h2_vs_h1_delta"),
        F.when(c("h1") != 0, pct(c("h2") - c("h1"), c("h1"), 1)).alias("h2_growth_pct"),
        _pattern(labels).alias("budget_pattern"),
    ).orderBy(c("annual_spend").desc_nulls_last(), "expense_type")


def q2c_entity_groups(t: Tables) -> DataFrame:
    """2C: spend by entity group (cost-centre parent)."""
    ent = dim(t.dim_entity, "entity_key", "entity_group", "entity_name")
    per_key = by_keys(_non_refund(t), ["entity_key"], {"n": m_count(), "spend": m_sum(c("amount")),
                                                        "n_amount": m_count_of(c("amount"))})
    g = per_key.join(ent, "entity_key").groupBy("entity_group").agg(
        F.count_distinct("entity_name").alias("cost_centers"), F.sum("n").alias("n"),
        F.sum("spend").alias("spend"), F.sum("n_amount").alias("n_amount"))
    return with_total(g, "spend").select(
        "entity_group", "cost_centers", c("n").alias("transactions"),
        money(c("spend")).alias("total_spend"),
        ratio(c("spend"), c("n_amount"), 2).alias("avg_per_transaction"),
        pct(c("spend"), c("grand_total"), 2).alias("pct_of_total"),
    ).orderBy(c("total_spend").desc_nulls_last(), "entity_group")


# --------------------------------------------------------------------- use case 3

def q3a_monthly_trend(t: Tables) -> DataFrame:
    """3A: monthly net spend (refunds included), refund amount and month-on-month change."""
    dd = dim(t.dim_date, "date_key", "year", "month", "month_name", "uk_fiscal_year",
             "uk_fiscal_quarter")
    per_key = by_keys(t.fact.where(c("amount").isNotNull()), ["date_key"],
                      {"n": m_count(), "spend": m_sum(c("amount")),
                       "refund": m_sum(when_refund(c("amount"), 1))})
    m = per_key.join(dd, "date_key").groupBy(
        "year", "month", "month_name", "uk_fiscal_year", "uk_fiscal_quarter").agg(
        F.sum("n").alias("n"), F.sum("spend").alias("spend"), F.sum("refund").alias("refund"))
    prev = F.lag("spend").over(Window.orderBy("year", "month"))  # one row per month
    return m.select(
        "year", "month", "month_name", "uk_fiscal_quarter", c("n").alias("transactions"),
        money(c("spend")).alias("total_spend"), money(c("refund")).alias("refund_amount"),
        money(c("spend") - prev).alias("mom_delta"),
        pct(c("spend") - prev, prev, 1).alias("mom_change_pct"),
    ).orderBy("year", "month")


def q3b_entity_rank_movement(t: Tables, max_rank: int = 10) -> DataFrame:
    """3B: top cost centres per month, with rank movement vs the previous top-k month."""
    months = t.dim_date.select(F.floor(c("date_key") / 100).cast("int").alias("_month"), "year", "month", "month_name").distinct()
    ent = dim(t.dim_entity, "entity_key", "entity_name", "entity_group")
    # a date key holds its month: months, not days, are shuffled
    per_key = by_keys(_dated(t).where(c("is_refund") == 0).withColumn("_month", F.floor(c("date_key") / 100).cast("int")),
                      ["entity_key", "_month"], {"spend": m_sum(c("amount"))})
    m = (per_key.join(months, "_month").join(ent, "entity_key")
                .groupBy("year", "month", "month_name", "entity_name", "entity_group")
                .agg(F.sum("spend").alias("spend")))
    by_month = Window.partitionBy("year", "month").orderBy(c("spend").desc_nulls_last())
    ranked = m.withColumn("monthly_rank", F.rank().over(by_month)).where(c("monthly_rank") <= max_rank)
    prev = F.lag("monthly_rank").over(Window.partitionBy("entity_name").orderBy("year", "month"))
    return ranked.select(
        "year", "month", "month_name", c("monthly_rank").cast("long").alias("monthly_rank"),
        "entity_group", "entity_name", money(c("spend")).alias("monthly_spend"),
        (c("monthly_rank") - prev).cast("long").alias("rank_movement"),
    ).orderBy("year", "month", "monthly_rank", "entity_name")


# --------------------------------------------------------------------- use case 4, 5

def q4a_refund_risk(t: Tables, limit: int | None = 15) -> DataFrame:
    """4A: refund rate per supplier with a risk flag (suppliers with spend and refunds)."""
    sup = dim(t.dim_supplier, "supplier_key", "supplier_name_clean")
    per_key = by_keys(t.fact, ["supplier_key"], {
        "gross": m_sum(when_refund(c("amount"), 0)), "refunded": m_sum(when_refund(F.abs(c("amount")), 1)),
        "refund_count": m_count_if(c("is_refund") == 1)})
    g = (per_key.join(sup, "supplier_key")
                .groupBy("supplier_name_clean")
                .agg(F.sum("gross").alias("gross"), F.sum("refunded").alias("refunded"),
                     F.sum("refund_count").alias("refund_count"))
                .where((c("gross") > 0) & (c("refund_count") > 0)))
    rate = (F.lit(100.0) * c("refunded").cast("double")) / F.nullif(c("gross").cast("double"), F.lit(0.0))
    out = g.select(
        "supplier_name_clean", money(c("gross")).alias("gross_spend"),
        money(c("refunded")).alias("total_refunded"), c("refund_count").cast("long").alias("refund_count"),
        pct(c("refunded"), c("gross"), 2).alias("refund_rate_pct"),
        F.when(rate > 10, RISK_LABELS[0]).when(rate > 3, RISK_LABELS[1]).otherwise(RISK_LABELS[2])
         .alias("risk_flag"))
    order = [c("refund_rate_pct").desc_nulls_last(), c("supplier_name_clean").asc_nulls_first()]
    return out.orderBy(*order).limit(limit) if limit else out.orderBy(*order)


def q4b_monthly_anomaly(t: Tables) -> DataFrame:
    """4B: monthly non-refund spend vs the average month (SPIKE > 1.5x, LOW < 0.6x)."""
    dd = dim(t.dim_date, "date_key", "year", "month", "month_name")
    per_key = by_keys(_non_refund(t), ["date_key"], {"spend": m_sum(c("amount"))})
    m = (per_key.join(dd, "date_key")
                .groupBy("year", "month", "month_name").agg(F.sum("spend").alias("spend")))
    # one row per calendar month: a window over all months is bounded by the calendar
    every = Window.partitionBy()
    m = m.withColumn("avg_s", F.sum("spend").over(every).cast("double") / F.count("spend").over(every))
    spend = c("spend").cast("double")
    return m.select(
        "year", "month", "month_name", money(c("spend")).alias("monthly_spend"),
        F.round(c("avg_s").cast("decimal(38,10)"), 2).cast("double").alias("avg_spend"),
        ratio(spend - c("avg_s"), c("avg_s"), 1, 100.0).alias("pct_vs_avg"),
        F.when(spend > F.lit(1.5) * c("avg_s"), ANOMALY_LABELS[0])
         .when(spend < c("avg_s") * F.lit(0.6), ANOMALY_LABELS[1])
         .otherwise(ANOMALY_LABELS[2]).alias("flag"),
    ).orderBy("year", "month")


def q5_executive_quarter(t: Tables) -> DataFrame:
    """5: per fiscal year and quarter: volume, distinct suppliers, gross, refunds, net, refund rate."""
    named = dim(t.dim_supplier, "supplier_key", "supplier_name_clean")
    known = _dated(t).where(c("supplier_key").isNotNull()).withColumn("_quarter", quarter_number(c("date_key")))
    quarters = t.dim_date.select(quarter_number(c("date_key")).alias("_quarter"), "uk_fiscal_year", "uk_fiscal_quarter").distinct()
    flows = by_keys(known, ["_quarter"], {
        "n": m_count(), "gross": m_sum(when_refund(c("amount"), 0)),
        "refunds": m_sum(when_refund(c("amount"), 1)), "net": m_sum(c("amount")),
        "refund_count": m_sum(c("is_refund"))})
    # (quarter, supplier) pairs are made distinct map-side, names are looked up for them only
    pairs = known.select("_quarter", "supplier_key").distinct().join(named, "supplier_key")
    suppliers = pairs.where(c("supplier_name_clean").isNotNull()).select("_quarter", "supplier_name_clean").distinct() \
        .groupBy("_quarter").agg(F.count(F.lit(1)).alias("unique_suppliers"))
    g = flows.join(F.broadcast(quarters), "_quarter").join(F.broadcast(suppliers), "_quarter", "left").fillna(
        0, ["unique_suppliers"])  # one row a quarter
    return g.select(
        "uk_fiscal_year", "uk_fiscal_quarter", c("n").alias("total_transactions"),
        "unique_suppliers", money(c("gross")).alias("gross_spend"),
        money(F.abs(c("refunds"))).alias("refunds"), money(c("net")).alias("net_spend"),
        c("refund_count").cast("long").alias("refund_count"),
        pct(c("refund_count"), c("n"), 2).alias("refund_rate_pct"),
    ).orderBy("uk_fiscal_year", "uk_fiscal_quarter")


REPORTS = {
    "q1a_top_suppliers": q1a_top_suppliers,
    "q1b_concentration": q1b_concentration,
    "q1c_supplier_quarter": q1c_supplier_quarter,
    "q2a_expense_types": q2a_expense_types,
    "q2b_half_year_pattern": q2b_half_year_pattern,
    "q2c_entity_groups": q2c_entity_groups,
    "q3a_monthly_trend": q3a_monthly_trend,
    "q3b_entity_rank_movement": q3b_entity_rank_movement,
    "q4a_refund_risk": q4a_refund_risk,
    "q4b_monthly_anomaly": q4b_monthly_anomaly,
    "q5_executive_quarter": q5_executive_quarter,
}


# The report runner's own forms of six reports: fewer columns, shorter lists.

def r1a_top_suppliers(t: Tables) -> DataFrame:
    """1A for the runner: 15 suppliers with share and rank, without the refund columns."""
    return q1a_top_suppliers(t, 15).select(
        "supplier_name_clean", "supplier_type", "transaction_count", F.round("gross_spend", 2).alias("gross_spend"),
        c("pct_of_total_spend").alias("pct_of_total"), "spend_rank")


def r1b_concentration(t: Tables) -> DataFrame:
    """1B for the runner: ranks up to 10."""
    return q1b_concentration(t, 10)


def r2a_expense_types(t: Tables) -> DataFrame:
    """2A for the runner: 15 types, without the largest transaction."""
    return q2a_expense_types(t, 15).drop("largest_transaction")


def r2b_half_year_pattern(t: Tables) -> DataFrame:
    """2B for the runner: 15 types, the difference and the short labels."""
    return q2b_half_year_pattern(t, 15, PATTERN_LABELS_SHORT).select(
        "expense_type", "h1_spend", "h2_spend", c("h2_vs_h1_delta").alias("delta"), c("budget_pattern").alias("pattern"))


def r3a_monthly_trend(t: Tables) -> DataFrame:
    """3A for the runner: the change in percent only."""
    return q3a_monthly_trend(t).select("year", "month", "month_name", "transactions", "total_spend",
                                       c("mom_change_pct").alias("mom_pct"))


def r4a_refund_risk(t: Tables) -> DataFrame:
    """4A for the runner: the 15 highest refund rates."""
    return q4a_refund_risk(t, 15)


RUNNER_REPORTS = {f.__name__: f for f in (r1a_top_suppliers, r1b_concentration, r2a_expense_types,
                                          r2b_half_year_pattern, r3a_monthly_trend, r4a_refund_risk)}


ALL_REPORTS = {**REPORTS, **RUNNER_REPORTS}


def run_all(t: Tables, names: list[str] | None = None, action=None, **params) -> dict:
    """Run every named report (by default all, the runner's forms included); one that fails is returned as its
    error, the rest still run.

    ``action`` (for instance ``lambda df: df.collect()``) runs a report, inside the same guard, and its result is
    returned; without it the lazy DataFrames are.

    ``params`` maps a report name to its keyword arguments, e.g. ``q1a_top_suppliers={"limit": 15}``.
    """
    out: dict = {}
    for name in names or list(ALL_REPORTS):
        try:
            df = ALL_REPORTS[name](t, **params.get(name, {}))
            out[name] = action(df) if action else df
        except Exception as e:  # noqa: BLE001 - isolate one report's failure
            out[name] = e
    return out


def report_rows(t: Tables) -> DataFrame:
    """(report, rows): one run of every report, and how many rows each gives."""
    counted = run_all(t, action=lambda df: df.agg(F.count(F.lit(1)).alias("rows")))
    failed = {n: e for n, e in counted.items() if isinstance(e, Exception)}
    if failed:
        raise RuntimeError(f"reports that cannot be built: {failed}")
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias("report"), "rows") for n, df in counted.items()])


def display_expense_types(t: Tables) -> DataFrame:
    """2A as it is printed: money with thousands separators."""
    money_cols = ["total_spend", "avg_transaction", "largest_transaction"]
    return formatted(q2a_expense_types(t, limit=None), money_cols).select("expense_type", *money_cols)
