"""Whitening of embeddings: principal components of all vectors, projected and scaled to unit variance.

1. Vectors become whole numbers; their number n and sums S are exact.
2. One pass adds up the products of the centred vectors. A vector is centred before it is multiplied, by the
   whole part of the mean first, so that a mean far from zero costs no digits.
3. The covariance, a square of the vector length, is solved on the driver: Householder reflections make it
   tridiagonal, counts of sign changes in Sturm sequences enclose the leading eigenvalues by bisection, inverse
   iteration gives their vectors, those of close eigenvalues being made orthogonal to each other.
4. The components are broadcast (their size depends on the vector length only) and every vector is projected.
   The covariance of the projections is measured over all vectors once more.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import arrow_map
from ledgerline.llm.vectors import dimension, largest, matrix, second_moments, usable, whole

#: Components whose eigenvalue is this share of the largest or less have no variance that can be told from rounding.
NO_VARIANCE = 1e-11
_EPS = float(np.finfo(np.float64).eps)


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and orthogonal q of a symmetric matrix: a = q t q'."""
    a, n = np.array(a, np.float64), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        x = a[k + 1:, k]
        scale = np.abs(x).max()
        if not scale or not np.abs(x[1:]).max():
            continue
        v = x / scale
        v[0] += np.copysign(np.sqrt(v @ v), v[0])
        v /= np.sqrt(v @ v)
        # both sides of the remaining square are reflected at once
        p = a[k + 1:, k + 1:] @ v
        w = 2 * (p - (v @ p) * v)
        a[k + 1:, k + 1:] -= np.outer(v, w) + np.outer(w, v)
        a[k + 1:, k] -= 2 * (v @ x) * v
        a[k, k + 1:] = a[k + 1:, k]
        q[:, k + 1:] -= 2 * np.outer(q[:, k + 1:] @ v, v)
    return np.diag(a).copy(), np.diag(a, -1).copy(), q


def count_below(d: np.ndarray, e: np.ndarray, x: np.ndarray) -> np.ndarray:
    """How many eigenvalues of the tridiagonal matrix lie below each ``x``: negative terms of its Sturm sequence."""
    tiny = _EPS * max(np.abs(d).max(initial=0), np.abs(e).max(initial=0)) ** 2 + np.finfo(np.float64).tiny
    squares = np.concatenate([[0.0], e * e])
    term, count = np.ones_like(x), np.zeros(len(x), np.int64)
    for i in range(len(d)):
        term = d[i] - x - squares[i] / term
        term = np.where(np.abs(term) < _EPS * np.sqrt(tiny), -_EPS * np.sqrt(tiny), term)
        count += term < 0
    return count


def leading_values(d: np.ndarray, e: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` largest eigenvalues, falling, each enclosed by bisection until no double lies between."""
    n = len(d)
    around = np.concatenate([[0.0], np.abs(e)]) + np.concatenate([np.abs(e), [0.0]])
    wide = 4 * _EPS * max(np.abs(d).max(), around.max()) + np.finfo(np.float64).tiny
    low = np.full(k, (d - around).min() - wide)
    high = np.full(k, (d + around).max() + wide)
    at_most = n - 1 - np.arange(k)  # so many eigenvalues are smaller
    while True:
        mid = low + (high - low) / 2
        if not ((mid > low) & (mid < high)).any():
            return mid
        above = count_below(d, e, mid) <= at_most
        low, high = np.where(above, mid, low), np.where(above, high, mid)


def _shifted(d: np.ndarray, e: np.ndarray, shift: float, tiny: float):
    """Factors of t - shift by elimination with row exchanges; a vanishing pivot becomes ``tiny``."""
    n = len(d)
    u0, u1, u2 = d - shift, np.append(e, 0.0), np.zeros(n)
    swap, factor = np.zeros(n, bool), np.zeros(n)
    for i in range(n - 1):
        below = (e[i], u0[i + 1], u1[i + 1])
        if abs(below[0]) > abs(u0[i]):
            swap[i] = True
            (u0[i], u1[i], u2[i]), below = below, (u0[i], u1[i], u2[i])
        if not u0[i]:
            u0[i] = tiny
        factor[i] = below[0] / u0[i]
        u0[i + 1] = below[1] - factor[i] * u1[i]
        u1[i + 1] = below[2] - factor[i] * u2[i]
    u0 = np.where(np.abs(u0) < tiny, np.copysign(tiny, u0), u0)

    def solve(b: np.ndarray) -> np.ndarray:
        b = b.copy()
        for i in range(n - 1):
            if swap[i]:
                b[i], b[i + 1] = b[i + 1], b[i]
            b[i + 1] -= factor[i] * b[i]
        for i in range(n - 1, -1, -1):
            if i + 1 < n:
                b[i] -= u1[i] * b[i + 1]
            if i + 2 < n:
                b[i] -= u2[i] * b[i + 2]
            b[i] /= u0[i]
            if abs(b[i]) > 1e200:
                b /= abs(b[i])
        return b

    return solve


def leading_vectors(d: np.ndarray, e: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Unit eigenvectors (columns) of falling ``values`` by inverse iteration.

    Each is kept orthogonal to those before it in its cluster of close values.
    """
    n, k = len(d), len(values)
    norm = max(np.abs(d).max(), np.abs(e).max(initial=0), np.finfo(np.float64).tiny)
    draw = np.random.default_rng(13)
    out, first = np.zeros((n, k)), 0
    for j in range(k):
        if j and values[j - 1] - values[j] > 1e-3 * norm:
            first = j
        before = out[:, first:j]
        # equal values are set apart by a few units in the last place
        solve = _shifted(d, e, values[j] - 4 * _EPS * norm * (j - first), _EPS * norm)
        x = draw.uniform(-1, 1, n)
        for _ in range(6):
            x -= before @ (before.T @ x)
            x = solve(x / np.sqrt(x @ x))
            x /= np.abs(x).max()
            for _ in range(2):
                x -= before @ (before.T @ x)
                x /= np.sqrt(x @ x)
        out[:, j] = x
    return out


@dataclass(frozen=True)
class Whitening:
    """What the vectors were fitted to."""

    n: int
    sums: list[int]           # of the whole-number vectors, per dimension
    scale: int
    plus: int
    values: np.ndarray        # leading eigenvalues of the covariance, falling
    explained: np.ndarray     # their shares of the trace
    components: np.ndarray    # (dimensions, components)

    @property
    def dim(self) -> int:
        return len(self.sums)

    @property
    def usable(self) -> int:
        """Components with variance; the others cannot be scaled to unit variance."""
        if not len(self.values) or self.values[0] <= 0:
            return 0
        return int((self.values > NO_VARIANCE * self.values[0]).sum())

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n, to double precision: first the whole part of the mean is taken off, exactly."""
        floor = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (x - floor) - rest

    def project(self, x: np.ndarray) -> np.ndarray:
        k = self.usable
        return (self.centred(x) @ self.components[:, :k]) / np.sqrt(self.values[:k])


def _vectors(rows: DataFrame, vec_col: str) -> DataFrame:
    return rows.where(usable(F.col(vec_col)))


def fit(rows: DataFrame, components: int = 32, scale: int = 64, plus: int = 1_000_000,
        vec_col: str = "embedding") -> Whitening | None:
    """Fit to all usable vectors of ``rows``; None if there is none, or none has a component."""
    good = _vectors(rows, vec_col)
    dim = dimension(good, vec_col)
    if not dim:
        return None
    x = good.select(whole(F.col(vec_col), scale, dim, plus).alias("x"))
    sums = (x.select(F.posexplode("x").alias("i", "v")).groupBy("i")
            .agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("v").cast("decimal(38,0)")).alias("s")).orderBy("i").collect())
    n = sums[0].n
    empty = Whitening(n, [int(r.s) for r in sums], scale, plus, np.zeros(0), np.zeros(0), np.zeros((dim, 0)))
    cov = second_moments(x, "x", dim, empty.centred) / n
    d, e, q = tridiagonal(cov)
    k = min(components, dim)
    values = leading_values(d, e, k)
    vectors = q @ leading_vectors(d, e, values)
    vectors /= np.sqrt((vectors * vectors).sum(0))
    values = np.maximum(0.0, ((cov @ vectors) * vectors).sum(0))  # an eigenvalue as the variance along its vector
    trace = float(np.trace(cov))
    explained = values / trace if trace > 0 else np.full(k, np.nan)
    return Whitening(n, empty.sums, scale, plus, values, explained, vectors)


def identity_error(rows: DataFrame, model: Whitening, vec_col: str = "embedding") -> float | None:
    """Largest absolute entry of the covariance of all projected vectors minus the identity; None without components."""
    if not model.usable:
        return None
    x = _vectors(rows, vec_col).select(whole(F.col(vec_col), model.scale, model.dim, model.plus).alias("x"))
    # projections of centred vectors: their mean is zero
    got = second_moments(x, "x", model.dim, model.project) / model.n
    return float(np.abs(got - np.eye(len(got))).max())


def transform(rows: DataFrame, model: Whitening, error: float | None, id_col: str = "vec_id",
              vec_col: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error), one row a usable vector and component."""
    k, usable_k, dim = len(model.values), model.usable, model.dim
    explained = [None if np.isnan(v) else float(v) for v in model.explained]

    def deviations(x: np.ndarray) -> pa.Array:
        # the mean's whole part first: the differences are small where the numbers are large
        near = x - np.array([s // model.n for s in model.sums], np.int64)
        rest = np.array([s % model.n for s in model.sums], np.int64)
        if (model.n * (largest(near) + 1)) ** 2 * dim < 1 << 63:
            far = model.n * near - rest
            return pa.array((far * far).sum(1)).cast(pa.decimal128(38, 0))
        far = model.n * near.astype(object) - rest
        return pa.array([int(v) for v in (far * far).sum(1)], pa.decimal128(38, 0))

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            x = matrix(batch.column(1), dim)
            m = len(x)
            white = np.full((m, k), np.nan)
            white[:, :usable_k] = model.project(x)
            flat = white.ravel()
            which = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(which), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, model.n)), deviations(x).take(which),
                 pa.array(flat, mask=np.isnan(flat)), pa.array(explained * m, pa.float64()),
                 pa.array([error] * (m * k), pa.float64())],
                names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    x = _vectors(rows, vec_col).select(F.col(id_col).cast("long").alias("vec_id"),
                                       whole(F.col(vec_col), model.scale, dim, model.plus).alias("x"))
    return arrow_map(x, run, "vec_id long, component int, n long, deviation decimal(38,0), whitened double,"
                     " explained double, identity_error double")


def whiten(rows: DataFrame, components: int = 32, scale: int = 64, plus: int = 1_000_000, id_col: str = "vec_id",
           vec_col: str = "embedding") -> DataFrame:
    """Fit to all usable vectors of ``rows``, measure the fit and project every one of them; see :func:`transform`.

    Vectors that are null or hold null or non-finite components give no row and take no part in the fit. Shorter
    vectors are filled up with zero components; ids may be null or repeat, every row counts. Components without
    variance (all of them for a single vector or equal vectors) have whitened null and explained 0 (null if nothing
    varies), and do not enter identity_error. An empty table, or one of empty vectors, gives no rows. Other columns
    are not read. deviation is exact up to 38 digits; components are whole numbers within 62 bits, larger
    ones are read as the nearest of these.
    """
    model = fit(rows, components, scale, plus, vec_col)
    if model is None:
        return rows.sparkSession.createDataFrame(
            [], "vec_id long, component int, n long, deviation decimal(38,0), whitened double, explained double,"
            " identity_error double")
    return transform(rows, model, identity_error(rows, model, vec_col), id_col, vec_col)
