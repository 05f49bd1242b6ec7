"""Invariants of the built warehouse and determinism under a different partitioning."""

import pytest
from pyspark.sql import functions as F

from ledgerline import catalog
from ledgerline.operators import reports, views
from ledgerline.operators.warehouse import materialize_warehouse

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables(spark):
    return catalog.warehouse(spark, SF)


def test_fact_neither_drops_nor_fans_out(tables):
    assert tables.fact.count() == tables.staging.count()
    assert tables.fact.select("transaction_key").distinct().count() == tables.fact.count()


def test_dimensions_unique_on_grain(tables):
    grains = {"dim_supplier": ["supplier_name_raw", "supplier_postcode"],
              "dim_expense": ["expense_type", "expense_area"], "dim_entity": ["entity_name"],
              "dim_date": ["date_key"]}
    for name, grain in grains.items():
        df = getattr(tables, name)
        assert df.count() == df.select(*grain).distinct().count(), name


def test_gross_minus_refunds_is_net(tables):
    for r in views.v6_executive_summary(tables).collect():
        assert r.gross_spend - r.total_refunds == pytest.approx(r.net_spend, abs=1e-6)


def test_shares_sum_to_100(tables):
    total = reports.q2c_entity_groups(tables).agg(F.sum("pct_of_total")).first()[0]
    assert total == pytest.approx(100.0, abs=0.05)
    last = reports.q1b_concentration(tables, max_rank=10 ** 6).orderBy(F.desc("supplier_rank")).first()
    assert last.cumulative_pct == pytest.approx(100.0, abs=0.01)


def test_same_results_under_other_partitioning(spark, tables):
    before = {n: sorted(map(tuple, f(tables).collect()))
              for n, f in (("q5", reports.q5_executive_quarter), ("v4", views.v4_entity_monthly))}
    spark.conf.set("spark.sql.shuffle.partitions", "13")
    try:
        other = materialize_warehouse(spark, catalog.staging_from_tables(spark, SF).repartition(5))
        after = {n: sorted(map(tuple, f(other).collect()))
                 for n, f in (("q5", reports.q5_executive_quarter), ("v4", views.v4_entity_monthly))}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    strip = lambda rows: [tuple(v for v in r) for r in rows]
    assert strip(after["q5"]) == strip(before["q5"])
    # v4 carries surrogate keys (unique row keys, which depend on the partitioning): compare without them
    assert [r[1:] for r in after["v4"]] != [] and sorted(r[1:] for r in after["v4"]) == sorted(
        r[1:] for r in before["v4"])
