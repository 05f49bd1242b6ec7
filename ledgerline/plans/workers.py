"""Python code on the executors: this package is sent once an application, then Arrow functions can run there."""

from __future__ import annotations

import functools
import tempfile
import zipfile
from collections.abc import Callable
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


@functools.lru_cache(maxsize=None)
def _shipped(application_id: str, add_file: Callable[[str], None]) -> None:
    package = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='ledgerline-code-')}/ledgerline.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for p in sorted(package.rglob("*.py")):
            z.write(p, p.relative_to(package.parent))
    add_file(archive)


def ship(spark: SparkSession) -> None:
    """Send this package's code to the executors, once an application."""
    sc = spark.sparkContext
    _shipped(sc.applicationId, sc.addPyFile)


def arrow_map(df: DataFrame, fn: Callable, schema) -> DataFrame:
    """``df.mapInArrow``, after this package's code was sent to the executors."""
    ship(df.sparkSession)

    def run(batches):
        yield from fn(batches)
        pa.default_memory_pool().release_unused()  # the worker lives on and serves other operators

    return df.mapInArrow(run, schema)
