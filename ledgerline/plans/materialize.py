"""Materialisation points: write a table to the shared scratch folder and read it back.

Writing cuts lineage (a lost executor re-reads files instead of recomputing
the whole upstream plan) and turns later reads into pruned, pushed-down
Parquet scans.
"""

from __future__ import annotations

import threading
import uuid
from collections import Counter
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_dir


#: HotSpot interprets methods of more bytecode than this and never compiles them.
_MOST_BYTECODE = "8000"
_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"


def compiled_methods(spark: SparkSession) -> None:
    """Let stages whose fused method would be too long for the JVM to compile run as several shorter ones.

    Cleaning fuses to such a method, which is then interpreted for every row. A limit that the session
    sets itself, lower or higher, is kept.
    """
    if spark.conf.get(_METHOD_LIMIT, "65535") == "65535":  # Spark's default
        spark.conf.set(_METHOD_LIMIT, _MOST_BYTECODE)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_LOCK = threading.Lock()
_INSIDE: Counter[str] = Counter()
_KEPT: dict[str, str | None] = {}


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a query that runs inside go when it has ended, not when the driver next collects its garbage.

    For large steps that are written one after the other. The session's own setting comes back afterwards.
    """
    app = spark.sparkContext.applicationId
    with _LOCK:
        if not _INSIDE[app]:
            _KEPT[app] = spark.conf.get(_CLEANUP, None)
            spark.conf.set(_CLEANUP, "true")
        _INSIDE[app] += 1
    try:
        yield
    finally:
        with _LOCK:
            _INSIDE[app] -= 1
            if not _INSIDE[app]:
                kept = _KEPT.pop(app)
                spark.conf.unset(_CLEANUP) if kept is None else spark.conf.set(_CLEANUP, kept)


def new_location(spark: SparkSession, prefix: str) -> str:
    base = scratch_dir(spark).rstrip("/")
    return f"{base}/{prefix}-{uuid.uuid4().hex[:12]}"


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None, compression: str | None = None) -> DataFrame:
    """``df`` stored and read back; ``compression`` is worth naming for wide tables with a row a payment."""
    writer = df.write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.parquet(path)


#: Rows that a stored table may have and still be sent whole to every executor: some 100 bytes each.
MOST_SENT = 2_000_000


def sent_whole(stored: DataFrame) -> DataFrame:
    """A stored narrow table, to be sent whole to every executor by a join unless it has more than ``MOST_SENT`` rows.

    Its rows are counted (from the file footers). The planner goes by estimated bytes and would sooner shuffle all
    rows that the table is joined with.
    """
    return F.broadcast(stored) if stored.count() <= MOST_SENT else stored
