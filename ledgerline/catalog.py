"""Warehouse over the benchmark tables, built once per session and directory."""

from __future__ import annotations

import re
import threading
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators import checks, storage
from ledgerline.operators.staging import clean
from ledgerline.operators.warehouse import Tables, materialize_warehouse
from ledgerline.plans.materialize import compiled_methods, new_location, shuffles_removed, write_table
from ledgerline.schema import CANONICAL_COLS, STAGING_COLS
from ledgerline.sources.csv_export import dealt_by_month, export_csv, export_months
from ledgerline.sources.monthly_csv import Ingest, columns_added, header_audit, read_monthly, write_summary_csv
from ledgerline.sources.tables import payment_items, payment_rows, position, raw_payments, source_file


@dataclass(frozen=True)
class Landed:
    ingest: Ingest
    staging: DataFrame


_LOCK = threading.Lock()
_BUILT: dict[tuple[str, str], Tables] = {}
_LANDED: dict[tuple[str, str], Landed] = {}
_SAVED: dict[tuple[str, str], dict[str, str]] = {}


def staging_from_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cleaned staging rows for the benchmark tables."""
    return clean(raw_payments(spark, sf_dir))


def warehouse(spark: SparkSession, sf_dir: str) -> Tables:
    """Materialised star schema for ``sf_dir`` (built on first use in this session)."""
    compiled_methods(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _BUILT:
            _BUILT[key] = materialize_warehouse(spark, staging_from_tables(spark, sf_dir))
        return _BUILT[key]


def forget(sf_dir: str) -> None:
    """Build the warehouse of ``sf_dir`` anew when it is next asked for (its tables have changed)."""
    with _LOCK:
        for cache in (_BUILT, _LANDED, _SAVED):
            for key in [k for k in cache if k[1] == sf_dir.rstrip("/")]:
                del cache[key]


def stored_spend_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A report in SQL over the named tables of ``sf_dir``, which are saved on first use in this session."""
    t = warehouse(spark, sf_dir)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    database = "ledgerline_" + re.sub(r"\W", "_", key[1]).strip("_")
    with _LOCK:
        if key not in _SAVED:
            _SAVED[key] = storage.save_tables(t, database)
    return storage.spend_by_type(spark, database)


def staging(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored staging table behind :func:`warehouse`."""
    return warehouse(spark, sf_dir).staging


def _stored_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the payment rows are made of, stored: files with either header are written from it."""
    return write_table(payment_items(spark, sf_dir), new_location(spark, "csv-items"), compression="zstd")


def _monthly_files(spark: SparkSession, sf_dir: str) -> str:
    """The payment rows as monthly CSV files, with what real files hold besides: see :func:`landed`."""
    path = new_location(spark, "csv-months")
    order, line = F.shiftright(position(), 9), F.shiftright(position(), 6) % 8
    # a blank row after the first line of every tenth order
    after = F.when((order % 10 == 0) & (line == 1), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    # a month of a million orders is a file
    name = F.concat(F.replace(source_file(), F.lit(".csv"), F.lit("-")), F.floor(order / 1_000_000).cast("string"))
    items = _stored_items(spark, sf_dir).withColumn("_blank", F.explode(after))
    raw = payment_rows(dealt_by_month(items, name, position(), F.col("_blank")), True, "source", "_blank")
    order, line = F.shiftright("_row_idx", 9), F.shiftright("_row_idx", 6) % 8
    cents = F.when(line == 5, F.concat("amount", F.lit("0"))).when(line == 6, F.concat("amount", F.lit("5"))) \
        .when((line == 7) & (order % 2 == 0), F.concat(F.lit("GBP "), "amount"))
    late = (line == 2) & (order % 16 == 0)
    raw = raw.withColumns({"payment_date": F.when(late, "30/02/1999").otherwise(F.col("payment_date")), "amount": F.when(F.col("amount") == "NA", "NA").otherwise(F.coalesce(cents, "amount")),
                           "description": F.when(line == 4, F.concat("description", F.lit('\n"second line", more')))
                           .otherwise(F.col("description"))})
    rows = raw.withColumns({c: F.when(F.col("_blank") == 0, F.col(c)) for c in CANONICAL_COLS})
    odd = F.split_part(F.col("_source_file"), F.lit("_"), F.lit(2)).substr(4, 1).isin(*"13579")
    export_months(rows, path, odd)
    # a file that cannot be read: two headers that mean the same column
    bad = spark.range(3, numPartitions=1).select(F.col("id").alias("Amount"), F.col("id").alias(" amount "), F.lit("x").alias("Supplier"))
    bad.write.options(header=True, compression="gzip").csv(f"{path}/source=unreadable")
    return path


def landed(spark: SparkSession, sf_dir: str) -> Landed:
    """The payment rows as monthly CSV files, read by the CSV ingest, with their stored staging table (once a session).

    Files are in folders of their own and may repeat their names. Every second year lacks two columns; some rows are
    blank, some amounts have a third decimal or cannot be parsed, some descriptions hold quotes and a line
    end, and one file has the same header twice.
    """
    compiled_methods(spark)
    key = (spark.sparkContext.applicationId, sf_dir.rstrip("/"))
    with _LOCK:
        if key not in _LANDED:
            with shuffles_removed(spark):
                ingest = read_monthly(spark, _monthly_files(spark, sf_dir), "*.csv.gz")
                _LANDED[key] = Landed(ingest, write_table(ingest.staging(), new_location(spark, "csv-staging"), compression="zstd"))
        return _LANDED[key]


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The payment rows written as CSV files (two header variants), read back and cleaned, all of it anew in every run.

    Load-order columns are dropped (file names are part-file names).
    """
    compiled_methods(spark)
    path = new_location(spark, "csv-roundtrip")
    with shuffles_removed(spark):
        raw = payment_rows(_stored_items(spark, sf_dir), null_markers=True)
        export_csv(raw, path, variant=F.shiftright("_row_idx", 6) % 2 == 1)
    skip = {"row_id", "_source_file", "_load_timestamp"}
    return read_monthly(spark, path).staging().select(*[c for c in STAGING_COLS if c not in skip])


def _sources(got: Landed) -> DataFrame:
    """(file, source): the folder that a monthly file was written to, one row a file."""
    return got.ingest.audit.select("file", F.regexp_extract("path", "source=([^/]*)", 1).alias("source"))


def row_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File, position and payment of every row id of the monthly files' stored staging; ids that repeat would be one row."""
    got = landed(spark, sf_dir)
    ids = got.staging.groupBy("row_id").agg(
        F.first("_source_file").alias("file"), F.first("_row_idx").alias("position"), F.first("transaction_number").alias("transaction_number"))
    return ids.join(_sources(got), "file").select(F.col("source").alias("file"), "position", "transaction_number")


def headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Normalised header names of the monthly files, and how many files have each."""
    return header_audit(landed(spark, sf_dir).ingest)


def file_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the header audit says of every monthly file, and how many rows were loaded from it."""
    got = landed(spark, sf_dir)
    rows = got.staging.groupBy(F.col("_source_file").alias("file")).agg(F.count(F.lit(1)).alias("rows"))
    audit = got.ingest.audit.join(rows, "file", "left").fillna(0, ["rows"]).join(_sources(got), "file")
    return audit.select(F.col("source").alias("file"), "status", "columns", "columns_added", "detail", "rows")


def load_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load's counters for every monthly file."""
    got = landed(spark, sf_dir)
    out = checks.k6_load_quality(got.staging, got.ingest.raw_counts, columns_added(got.ingest)).join(_sources(got), "file")
    return out.withColumn("file", F.col("source")).drop("source")


def summary_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The load's counters written as the summary CSV and read back, in every run."""
    path, counters = new_location(spark, "summary-csv"), load_quality(spark, sf_dir)
    write_summary_csv(counters, path)
    return spark.read.option("header", True).schema(counters.schema).csv(path)
