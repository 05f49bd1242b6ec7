"""Dense keys in first-seen order, kept over rebuilds; dimensions without sorts; ranks of close values."""

import pytest
from conftest import raw_rows
from pyspark.sql import functions as F

from ledgerline.operators import profile
from ledgerline.operators.ranking import before, slot_of, with_rank
from ledgerline.operators.staging import clean
from ledgerline.operators.warehouse import GRAINS, build_warehouse, materialize_warehouse, members
from ledgerline.plans.materialize import new_location, write_table


def payments(spark, names, first_row=0):
    rows = [dict(department="D", supplier_name=n, supplier_postcode=p, amount="1", payment_date="01/04/2015", expense_area=a,
                 expense_type=None, _row_idx=first_row + i) for i, (n, p, a) in enumerate(names)]
    return clean(raw_rows(spark, rows).withColumn("_row_key", F.col("_row_idx")).repartition(3, "_row_idx"))


def keys(t, name):
    return {tuple(r[c] for c in GRAINS[name].columns): r[GRAINS[name].key] for r in t.keys[name].collect()}


def test_keys_are_dense_and_survive_reloads(spark):
    first = [("b", None, "x"), ("a", None, "y"), ("b", "P", None), ("b", None, "x"), (None, "P", None), ("c", "Q", "z")]
    one = materialize_warehouse(spark, payments(spark, first))
    assert keys(one, "dim_supplier") == {("b", None): 1, ("a", None): 2, ("b", "P"): 3, ("c", "Q"): 4}
    assert keys(one, "dim_entity") == {("x",): 1, ("y",): 2, ("z",): 3}
    # the second load lacks a member, brings new ones and has the others in another order
    second = [("c", "Q", "z"), ("z", None, "w"), ("b", "P", "x"), ("a", None, "v"), ("b", None, "x")]
    two = materialize_warehouse(spark, payments(spark, second[:-1]), keys=one.keys)
    assert keys(two, "dim_supplier") == {**keys(one, "dim_supplier"), ("z", None): 5}
    assert keys(two, "dim_entity") == {**keys(one, "dim_entity"), ("w",): 4, ("v",): 5}
    assert {r.supplier_key for r in two.dim_supplier.collect()} == {2, 3, 4, 5}
    # a member that was gone for a load has its key again
    three = materialize_warehouse(spark, payments(spark, second), keys=two.keys)
    assert {r.supplier_key for r in three.dim_supplier.collect()} == {1, 2, 3, 4, 5}
    assert keys(three, "dim_supplier") == keys(two, "dim_supplier")
    lazy = build_warehouse(payments(spark, first))
    assert keys(lazy, "dim_supplier") == keys(one, "dim_supplier") and lazy.fact.where("supplier_key IS NULL").count() == 1


def test_an_empty_load_has_no_keys(spark):
    t = materialize_warehouse(spark, payments(spark, [("a", None, None)]).where("false"))
    assert all(m.count() == 0 for m in t.keys.values()) and t.fact.count() == 0


def test_first_rows_are_found_without_sorting(spark):
    stg = write_table(payments(spark, [("a", None, "x")] * 20), new_location(spark, "stg"))
    for grain in GRAINS.values():
        plan = members(stg, grain)._jdf.queryExecution().executedPlan().toString()
        assert "HashAggregate" in plan and "SortAggregate" not in plan and "Sort [" not in plan


@pytest.mark.parametrize("descending", [True, False])
def test_before_adds_up_weights(spark, descending):
    df = spark.createDataFrame([(i * 37 % 101, i % 7) for i in range(101)] + [(None, 5)], "v int, w long").repartition(5)
    rows = sorted(df.collect(), key=lambda r: (r.v is None, (r.v or 0) * (-1 if descending else 1)))
    want, total = {}, 0
    for r in rows:
        want[r.v] = total
        total += r.w
    assert {r.v: r._before for r in before(df, "v", "w", descending).collect()} == want


def test_slots_by_binary_search(spark):
    borders = [1, 3, 3, 8, 20]
    df = spark.range(-2, 25).withColumn("b", F.array(*[F.lit(x) for x in borders]))
    got = {r.id: r.s for r in df.select("id", slot_of(F.col("id"), F.col("b"), 5).alias("s")).collect()}
    assert got == {i: sum(x < i for x in borders) for i in range(-2, 25)}


def test_close_values_are_spread_over_slots(spark):
    """Values within one percent of each other: no slot has more than twice its share."""
    df = spark.range(200_000).select((F.lit(1_000_000_000) + F.col("id") * 50).cast("decimal(18,2)").alias("v"))
    from ledgerline.operators import ranking
    seen = []
    real = ranking.slot_of
    ranking.slot_of = lambda value, borders, count: seen.append(count) or real(value, borders, count)
    try:
        ranked = with_rank(df, "v", descending=False)
        assert ranked.where(F.col("rank") != (F.col("v") - 1_000_000_000) / 50 + 1).count() == 0
    finally:
        ranking.slot_of = real
    count = seen[0]
    shares = F.array(*[F.lit((k + 1) / (count + 1)) for k in range(count)])
    cut = df.withColumn("b", df.agg(F.percentile_approx("v", shares, 50 * (count + 1))).scalar())
    sizes = [r["count"] for r in cut.groupBy(slot_of(F.col("v"), F.col("b"), count).alias("s")).count().collect()]
    assert len(sizes) == count + 1 and max(sizes) <= 2 * 200_000 / (count + 1)
    plan = with_rank(df, "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [_slot" in plan


def test_duplicates_by_fingerprint_are_exact(spark, monkeypatch):
    rows = [("a", None, "1"), (None, "a", "1"), ("a", None, "1"), ("a", "", "1"), ("x", "y", "2"), ("x", "y", "2"), ("x", "y", "2")]
    df = spark.createDataFrame(rows, "p string, q string, k string")
    assert tuple(profile.duplicate_counts(df, ["p", "q", "k"], "k").first()) == (3, 5)
    assert profile.duplicate_counts(df.limit(1), ["p", "q", "k"], "k").first().duplicate_rows == 0
    # every fingerprint the same: the cells decide
    monkeypatch.setattr(profile.F, "xxhash64", lambda *a: F.lit(7).cast("long"))
    assert tuple(profile.duplicate_counts(df, ["p", "q", "k"], "k").first()) == (3, 5)


def test_executive_view_needs_no_expansion(spark):
    from ledgerline.operators.views import v6_executive_summary
    df = v6_executive_summary(build_warehouse(payments(spark, [("a", None, "x"), ("b", None, "x"), ("b ", None, "y")])))
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()
    r = df.first()
    assert (r.total_transactions, r.unique_suppliers, r.active_cost_centers) == (3, 2, 2)
