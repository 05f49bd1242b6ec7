from pyspark.sql import functions as F
from pyspark.sql import Window

from ledgerline.operators.ranking import with_rank


def test_distributed_rank_matches_window(spark):
    rows = [(i, (i * 37) % 11 if i % 13 else None) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, v long").repartition(7)
    want = {r.id: r.rank for r in df.withColumn(
        "rank", F.rank().over(Window.orderBy(F.col("v").desc_nulls_last()))).collect()}
    got = {r.id: r.rank for r in with_rank(df, "v").collect()}
    assert got == want


def test_rank_of_signed_money(spark):
    rows = [(i, None if i % 17 == 0 else f"{(i * 7919 % 401 - 200) * 10 ** (i % 7)}.{i % 2}") for i in range(400)]
    df = spark.createDataFrame(rows, "id long, t string").selectExpr("id", "CAST(t AS DECIMAL(18,2)) AS v")
    for descending, order in ((True, F.col("v").desc_nulls_last()), (False, F.col("v").asc_nulls_last())):
        want = {r.id: r.rank for r in df.withColumn("rank", F.rank().over(Window.orderBy(order))).collect()}
        assert {r.id: r.rank for r in with_rank(df, "v", descending=descending).collect()} == want
