"""Named tables: declared schemas, whole replacement, pruned partitions, joins without a shuffle."""

import pytest
from conftest import raw_rows

from ledgerline.operators.staging import clean
from ledgerline.operators.storage import declared, save_tables, spend_by_type
from ledgerline.operators.warehouse import build_warehouse
from ledgerline.schema import TABLE_SCHEMAS, table_schema


def tables(spark, rows):
    return build_warehouse(clean(raw_rows(spark, [dict(department="D", supplier_name=n, amount=a, payment_date=d, expense_area="G - A",
                                                       supplier_type="T") for n, a, d in rows])))


@pytest.fixture
def database(spark):
    name = "stored_test"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_saved_tables_are_replaced_as_a_whole(spark, database):
    save_tables(tables(spark, [("a", "1", "01/03/2015"), ("b", "2", "01/04/2015"), ("c", "4", "bad")]), database)
    fact = spark.table(f"{database}.fact_transactions")
    assert sorted((r.fiscal_start or 0, float(r.amount)) for r in fact.collect()) == [(0, 4.0), (2014, 1.0), (2015, 2.0)]
    for name in TABLE_SCHEMAS:
        assert [(f.name, f.dataType) for f in spark.table(f"{database}.{name}").schema] == [(f.name, f.dataType) for f in table_schema(name)]
    for k in range(3):
        save_tables(tables(spark, [("a", str(10 + k), "01/04/2016")]), database)
        assert [float(r.amount) for r in spark.table(f"{database}.fact_transactions").collect()] == [10.0 + k]
    stored = {r.tableName for r in spark.sql(f"SHOW TABLES IN {database} LIKE 'dim_entity_v*'").collect()}
    assert stored == {"dim_entity_v3", "dim_entity_v4"}
    # a reader that began on the last load still finds its files
    assert [float(r.amount) for r in spark.table(f"{database}.fact_transactions_v3").collect()] == [11.0]


def test_a_load_that_fails_leaves_the_old_tables(spark, database):
    good = tables(spark, [("a", "1", "01/03/2015")])
    save_tables(good, database)
    from dataclasses import replace
    with pytest.raises(ValueError, match="dim_entity lacks"):
        save_tables(replace(good, dim_entity=good.dim_entity.drop("entity_group")), database)
    assert spark.table(f"{database}.fact_transactions").count() == 1
    with pytest.raises(ValueError):
        declared(good.fact.drop("amount"), "fact_transactions")


def test_years_are_pruned_and_buckets_joined_in_place(spark, database):
    save_tables(tables(spark, [(f"s{i}", "1", f"01/{1 + i % 12:02d}/{2010 + i % 5}") for i in range(60)]), database)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spend_by_type(spark, database, 2013)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "PartitionFilters: [isnotnull(fiscal_start" in plan and "fiscal_start#" in plan
    join = plan[plan.index("SortMergeJoin"):]
    assert "Exchange" not in join and "Bucketed: true" in join
    assert sum(r.transactions for r in df.collect()) == sum(
        2010 + i % 5 - (1 + i % 12 < 4) >= 2013 for i in range(60))
