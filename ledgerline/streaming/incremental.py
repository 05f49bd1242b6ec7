"""Incremental ingest: load monthly CSV files as they land, exactly once.

A file-source stream over the landing folder tracks which ``*.csv`` files
have been seen (in the stream's checkpoint, so a restarted job neither skips
nor repeats a file). Each micro-batch carries only file paths and sizes (contents are
never read by the listing); ``foreachBatch`` runs the batch ingest on those
files and writes their staging rows, replacing only their own source-file
partitions. A row is known by its file and position; the load order over all files follows from both when
the warehouse is rebuilt from the stored staging table.

``availableNow`` processes everything that has landed and stops, which suits
a scheduled job; any other trigger keeps the query running.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerline.operators.warehouse import Tables, materialize_warehouse
from ledgerline.schema import load_key
from ledgerline.sources.monthly_csv import read_files, write_staging

_BINARY_FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def _load_batch(staging_path: str):
    def load(batch: DataFrame, batch_id: int) -> None:
        files = batch.select("path").collect()  # bounded by maxFilesPerTrigger
        if files:
            write_staging(read_files(batch.sparkSession, [r.path for r in files]).staging(), staging_path)
    return load


def load_new_files(spark: SparkSession, landing_dir: str, staging_path: str, checkpoint: str,
                   max_files_per_batch: int = 12, available_now: bool = True):
    """Start (and, with ``available_now``, finish) the incremental load; returns the query."""
    files = (spark.readStream.format("binaryFile").schema(_BINARY_FILE_SCHEMA)
                  .option("pathGlobFilter", "*.csv")
                  .option("maxFilesPerTrigger", max_files_per_batch).load(landing_dir).select("path", "length"))
    writer = (files.writeStream.foreachBatch(_load_batch(staging_path))
                   .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def in_load_order(staging: DataFrame) -> DataFrame:
    """``staging`` with load-order keys over all its files, however many batches brought them: by file name, then position."""
    number = F.row_number().over(Window.orderBy("_source_file"))  # one row a file
    files = staging.select("_source_file").distinct().withColumn("_number", number)
    keyed = staging.join(files, "_source_file").withColumn("_row_key", load_key(F.col("_number"), F.col("_row_idx")))
    return keyed.select(*staging.columns)


def refresh_warehouse(spark: SparkSession, staging_path: str, location: str | None = None,
                      keys: dict[str, DataFrame] | None = None) -> Tables:
    """Full rebuild of the star schema from the stored staging table; ``keys`` as for ``materialize_warehouse``."""
    return materialize_warehouse(spark, in_load_order(spark.read.parquet(staging_path)), location, keys)
