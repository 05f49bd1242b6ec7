"""Embeddings as whole numbers: usable rows, one length, exact products, sums over all rows."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map


def usable(vector: Column) -> Column:
    """The vector is there and all its components are finite numbers (an empty vector is)."""
    wide = F.transform(vector, lambda c: c.cast("double"))
    odd = F.exists(wide, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == F.lit(float("inf"))))
    return vector.isNotNull() & ~odd


def whole(vector: Column, scale: int, dim: int, plus: int = 0) -> Column:
    """floor(``scale`` * component) + ``plus`` as longs; shorter vectors are filled up with zero components.

    Products beyond 62 bits are read as the nearest of 62 bits.
    """
    end = F.lit(2.0 ** 62)
    x = F.transform(vector, lambda c: F.floor(F.greatest(-end, F.least(end, c.cast("double") * F.lit(float(scale)))))
                    + F.lit(plus).cast("long"))
    missing = F.array_repeat(F.lit(plus).cast("long"), F.lit(dim) - F.size(vector))
    return F.concat(x, missing)


def dimension(rows: DataFrame, vec_col: str) -> int:
    """Components of the longest vector."""
    return rows.agg(F.max(F.size(vec_col))).first()[0] or 0


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) of a column of lists that all have ``dim`` numbers."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dim)


def largest(x: np.ndarray) -> int:
    """The largest absolute value, as a Python number (so that products of it never wrap)."""
    return max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of ``a`` with all rows of ``b`` (longs); OverflowError if one does not fit."""
    bound = largest(a) * largest(b) * max(1, a.shape[1])
    if bound < 1 << 53:  # every partial sum is a whole number that a double holds
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    if bound < 1 << 63:
        return a @ b.T
    exact = a.astype(object) @ b.astype(object).T
    return np.array(exact.tolist(), np.int64).reshape(exact.shape)


def second_moments(rows: DataFrame, column: str, dim: int, shape: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum of v v' over all rows, v = ``shape`` of the row's numbers (a matrix of rows at a time), in doubles.

    Each task adds up its own rows; Spark adds the tasks' sums cell by cell, and only the sums of all
    rows, half a square of the vector length, come to the driver.
    """
    def run(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                v = shape(matrix(batch.column(0), dim))
                total = v.T @ v if total is None else total + v.T @ v
        if total is not None:
            i, j = np.tril_indices(len(total))
            yield pa.RecordBatch.from_pydict({"i": pa.array(i), "j": pa.array(j), "s": pa.array(total[i, j])})

    cells = arrow_map(rows.select(column), run, "i long, j long, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    got = cells.toPandas()
    size = int(got["i"].max()) + 1 if len(got) else 0
    out = np.zeros((size, size))
    out[got["i"], got["j"]] = got["s"]
    return out + np.tril(out, -1).T
