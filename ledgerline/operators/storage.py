"""Named warehouse tables with declared schemas, replaced as a whole.

Each load writes its tables under names of its own (``fact_transactions_v3``) and then points the public names,
which are views, to them: a reader sees all of the old load or all of the new one, never half of it. Tables of the load
before last are dropped, so that queries which began on the last one can end.

The fact is partitioned by fiscal year, so a filter on it reads only those folders, and bucketed by supplier
like the supplier dimension, so that their join shuffles neither side.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.warehouse import Tables
from ledgerline.plans.materialize import new_location
from ledgerline.schema import TABLE_SCHEMAS, table_schema

#: Column that the fact is partitioned by: the year in which the payment's fiscal year began (NULL without a date).
FISCAL_START = "fiscal_start"


def with_fiscal_start(fact: DataFrame) -> DataFrame:
    year, month = F.floor(F.col("date_key") / 10_000), F.floor(F.col("date_key") / 100) % 100
    return fact.withColumn(FISCAL_START, (year - (month < 4).cast("int")).cast("int"))


def declared(df: DataFrame, name: str) -> DataFrame:
    """``df`` with the columns, order and types that the schema of table ``name`` declares.

    A missing column, or a value that its type cannot hold, is an error.
    """
    schema = table_schema(name)
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"{name} lacks {missing}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema])


def _versions(spark: SparkSession, database: str, name: str) -> list[int]:
    found = spark.sql(f"SHOW TABLES IN {database} LIKE '{name}_v*'").collect()
    return sorted(int(m[1]) for r in found if (m := re.fullmatch(rf"{name}_v(\d+)", r.tableName)))


def save_tables(t: Tables, database: str = "ledgerline", location: str | None = None, buckets: int = 8) -> dict[str, str]:
    """Write all tables of ``t`` and point the public names in ``database`` to them; the stored name of each.

    ``location`` is a folder that all machines share (by default under the checkpoint folder); ``buckets`` is how many
    buckets the fact and the supplier dimension have: about the data of a year over what a task holds.
    """
    spark = t.fact.sparkSession
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    base = location or new_location(spark, "tables")
    frames = {"fact_transactions": with_fiscal_start(t.fact), **{n: getattr(t, n) for n in TABLE_SCHEMAS if n.startswith("dim_")}}
    version = 1 + max((v for n in frames for v in _versions(spark, database, n)), default=0)
    stored = {}
    for name, df in frames.items():
        writer = declared(df, name).write.format("parquet").option("path", f"{base}/{name}_v{version}")
        if name == "fact_transactions":
            writer = writer.partitionBy(FISCAL_START)
        if name in ("fact_transactions", "dim_supplier"):
            writer = writer.bucketBy(buckets, "supplier_key").sortBy("supplier_key")
        stored[name] = f"{database}.{name}_v{version}"
        writer.saveAsTable(stored[name])
    for name, target in stored.items():
        spark.sql(f"CREATE OR REPLACE VIEW {database}.{name} AS SELECT * FROM {target}")
        for old in _versions(spark, database, name)[:-2]:
            spark.sql(f"DROP TABLE {database}.{name}_v{old}")
    return stored


#: Spend by fiscal year and supplier type over the named tables, from one year on.
SPEND_BY_TYPE = """
SELECT f.fiscal_start, s.supplier_type, COUNT(*) AS transactions, CAST(SUM(f.amount) AS DOUBLE) AS net_spend,
       COUNT(DISTINCT s.supplier_name_clean) AS suppliers
FROM {database}.fact_transactions f JOIN {database}.dim_supplier s ON f.supplier_key = s.supplier_key
WHERE f.fiscal_start >= {first} GROUP BY f.fiscal_start, s.supplier_type
"""


def spend_by_type(spark: SparkSession, database: str = "ledgerline", first: int = 1996) -> DataFrame:
    return spark.sql(SPEND_BY_TYPE.format(database=database, first=first))
