"""Plan shape: pushdown, pruning, bounded broadcasts, window-group limits, pre-aggregation."""

import pytest

from ledgerline import catalog
from ledgerline.operators import reports

SF = "/root/testdata/sf0.001"


def executed(df):
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def tables(spark):
    return catalog.warehouse(spark, SF)


def test_rank_filter_gets_window_group_limit(tables):
    # only the top rows of each partition reach the single-partition window
    plan = executed(reports.q1b_concentration(tables))
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_filters_pushed_and_columns_pruned(tables):
    df = reports.q2a_expense_types(tables)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(is_refund), EqualTo(is_refund,0)" in plan
    fact_scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "is_refund" in line]
    assert fact_scans and all("description" not in s and "row_id" not in s for s in fact_scans)
    assert all("ReadSchema: struct<expense_key:bigint,amount:decimal(28,2),is_refund:int>" in s
               for s in fact_scans)


def test_broadcast_dims_join_map_side(tables):
    plan = executed(reports.q5_executive_quarter(tables))
    lines = plan.splitlines()
    join = next(i for i, s in enumerate(lines) if "BroadcastHashJoin" in s)
    # small dimensions are broadcast by the planner, without a hint
    below = [s for s in lines[join:] if "BroadcastExchange" not in s]
    assert "SortMergeJoin" not in plan
    assert any("FileScan parquet" in s and "is_refund" in s for s in below)


def test_fact_aggregated_before_large_dimension_join(tables):
    plan = reports.q1c_supplier_quarter(tables)._jdf.queryExecution().optimizedPlan().toString()
    lines = plan.splitlines()
    join = next(i for i, s in enumerate(lines) if "Join Inner" in s)
    assert any("Aggregate [supplier_key" in s for s in lines[join:])  # fact aggregated on the keys first


def test_calendar_attributes_need_no_daily_rows(tables):
    """Quarter, half year and month follow from the date key: no report but the daily ones groups by day."""
    for name in ("q1c_supplier_quarter", "q2b_half_year_pattern", "q3b_entity_rank_movement", "q5_executive_quarter"):
        plan = reports.REPORTS[name](tables)._jdf.queryExecution().optimizedPlan().toString()
        assert "Aggregate [date_key" not in plan and "date_key#" in plan, name


def test_building_a_report_starts_no_job(spark, tables):
    tracker, group = spark.sparkContext.statusTracker(), "report-building"
    spark.sparkContext.setJobGroup(group, "")
    for fn in reports.REPORTS.values():
        fn(tables)
    jobs = list(tracker.getJobIdsForGroup(group))
    spark.sparkContext.setJobGroup("other", "")
    assert not jobs


def test_long_methods_are_cut_for_the_jvm_to_compile(spark):
    from ledgerline.plans.materialize import compiled_methods
    name = "spark.sql.codegen.hugeMethodLimit"
    kept = spark.conf.get(name, None)
    try:
        spark.conf.unset(name)
        compiled_methods(spark)
        assert spark.conf.get(name) == "8000"
        spark.conf.set(name, "5000")  # the session's own limit
        compiled_methods(spark)
        assert spark.conf.get(name) == "5000"
    finally:
        spark.conf.set(name, kept) if kept else spark.conf.unset(name)


@pytest.fixture
def no_automatic_broadcast(spark):
    """What the planner does with tables that it takes to be large."""
    name = "spark.sql.autoBroadcastJoinThreshold"
    kept = spark.conf.get(name)
    spark.conf.set(name, "-1")
    yield
    spark.conf.set(name, kept)


def test_repeated_rows_are_found_without_shuffling_all_cells(spark, no_automatic_broadcast):
    from ledgerline.operators import profile
    rows = [("a", None, "1"), ("a", None, "1"), ("a", None, "2"), (None, "a", "1"), (None, "a", None)]
    df = profile.duplicate_counts(spark.createDataFrame(rows, "x string, y string, k string"), ["x", "y", "k"], "k")
    assert "SortMergeJoin" not in df._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in df.collect()] == [(1, 2)]


def test_facts_are_not_shuffled_to_small_dimensions(spark, no_automatic_broadcast, monkeypatch):
    from conftest import raw_rows
    from ledgerline.operators import warehouse
    from ledgerline.operators.staging import clean
    plans = []

    def noted(df, path, *args, **kwargs):
        plans.append((path, df._jdf.queryExecution().executedPlan().toString()))
        return write(df, path, *args, **kwargs)

    write = warehouse.write_table
    monkeypatch.setattr(warehouse, "write_table", noted)
    rows = [{"supplier_name": n, "supplier_postcode": p, "expense_type": e, "expense_area": "A - B", "amount": "1", "payment_date": "1/4/2015"}
            for n, p, e in [("x", None, "t"), ("x", "N1", "t"), (None, "N1", None), ("x", None, "u")]]
    t = warehouse.materialize_warehouse(spark, clean(raw_rows(spark, rows)))
    fact = next(p for path, p in plans if path.endswith("fact_transactions"))
    assert fact.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in fact
    got = sorted((r.supplier_key, r.expense_key, r.entity_key) for r in t.fact.where("supplier_key is not null").collect())
    assert got == [(1, 1, 1), (1, 3, 1), (2, 1, 1)] and t.fact.where("supplier_key is null").count() == 1


def test_reload_reads_the_rows_once_a_dimension(spark):
    from pyspark.sql import functions as F
    from conftest import raw_rows
    from ledgerline.operators import warehouse
    from ledgerline.operators.staging import clean
    early = raw_rows(spark, [{"supplier_name": n, "expense_area": "A"} for n in ("b", "a")], "april_2015.csv")
    late = raw_rows(spark, [{"supplier_name": n, "expense_area": "A"} for n in ("c", "a", "0")], "may_2015.csv")
    stg = clean(early.unionByName(late.withColumn("_row_key", F.col("_row_key") + (1 << 40))))
    t = warehouse.materialize_warehouse(spark, stg)
    out = warehouse.keys_after_reload(t)
    assert not any("stg_transactions" in f for f in out.inputFiles())
    got = {(r.name1, r.is_new, r.member_key) for r in out.where("dimension = 'dim_supplier'").collect()}
    assert got == {("b", False, 1), ("a", False, 2), ("c", True, 3), ("0", True, 4)}


def test_shuffle_files_go_with_their_query(spark, tmpdir_path):
    import os
    from ledgerline.plans.materialize import shuffles_removed, write_table
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    folder = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def files():
        return {f for d in folder for _, _, names in os.walk(d) for f in names if f.startswith("shuffle_")}

    kept, df = spark.conf.get(name, None), spark.range(1000).repartition("id")
    before = files()
    with shuffles_removed(spark):
        with shuffles_removed(spark):
            pass
        stored = write_table(df, f"{tmpdir_path}/a")
        assert stored.count() == 1000 and df.count() == 1000  # a frame can be used again
    assert spark.conf.get(name, None) == kept
    assert files() <= before
    write_table(spark.range(1000).repartition("id"), f"{tmpdir_path}/b")
    assert files() - before  # as the session has it
