"""Warehouse tables and reporting views are queryable with plain Spark SQL."""

from ledgerline import catalog
from ledgerline.operators import views

SF = "/root/testdata/sf0.001"


def test_sql_over_registered_tables(spark):
    t = catalog.warehouse(spark, SF)
    t.register()
    counts = views.register_views(t, count=True)
    assert all(n and n > 0 for n in counts.values())
    busiest = spark.sql("""
        SELECT entity_name, max_by(month_name, transaction_count) AS month_name, sum(transaction_count) AS n
        FROM vw_entity_monthly GROUP BY entity_name""").collect()
    dated = t.fact.where("date_key IS NOT NULL AND entity_key IS NOT NULL AND is_refund = 0").count()
    assert sum(r.n for r in busiest) == dated
    assert len(busiest) == t.dim_entity.count()
    top = spark.sql("SELECT supplier_name_clean FROM vw_supplier_summary WHERE spend_rank = 1").collect()
    assert len(top) >= 1
