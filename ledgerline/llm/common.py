"""What the training-data operators share: inputs, Arrow batches, stored steps."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from ledgerline.plans.materialize import new_location, write_table
from ledgerline.plans.workers import arrow_map, ship  # noqa: F401 (arrow_map: for the operators)

#: Bytes of text that one vectorised step holds at once (working arrays are a few times eight bytes a byte).
SLICE_BYTES = 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_of(text_col: str = "text") -> Column:
    """The text, with null read as empty."""
    return F.coalesce(F.col(text_col).cast("string"), F.lit(""))


def own_prefix(df: DataFrame) -> str:
    """A prefix that no column of ``df`` has, for helper columns beside the caller's."""
    prefix = "__"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the UTF-8 bytes of ``text``; every other column is left behind, so none can clash."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_of(text_col).cast("binary").alias("text"))


def arrow_pairs(one: DataFrame, two: DataFrame, keys: list[str], fn: Callable, schema: str) -> DataFrame:
    """``fn(rows of one, rows of two)`` for every value of ``keys`` that occurs in both tables, as Arrow tables."""
    ship(one.sparkSession)

    def run(a: pa.Table, b: pa.Table) -> pa.Table:
        if not len(a) or not len(b):
            return empty
        return fn(a, b)

    empty = to_arrow_schema(StructType.fromDDL(schema)).empty_table()
    return one.groupBy(*keys).cogroup(two.groupBy(*keys)).applyInArrow(run, schema)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back: later steps reread it instead of recomputing."""
    return write_table(df, new_location(df.sparkSession, name))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a binary or string column in one array, and where each row begins (n + 1 offsets from 0)."""
    wide = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64) if len(offsets) else np.zeros(1, np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(offsets: np.ndarray, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes; a longer row stands alone."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


def binary(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """A binary column of the pieces ``data[starts[i]:ends[i]]``."""
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    index = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[index]))]
    ).cast(pa.binary())


def longs(values: np.ndarray) -> pa.Array:
    """Unsigned or signed 64-bit values as Spark longs, bit by bit."""
    return pa.array(np.ascontiguousarray(values).view(np.int64))


def lists(values: pa.Array, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)
