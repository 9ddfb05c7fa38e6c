"""Whitening of embeddings: distributed centred covariance, eigenvectors of its tridiagonal form, broadcast projection.

The covariance is that of the distinct vectors, centred exactly in integers
before anything is multiplied. Its leading eigenpairs come from a Householder
tridiagonalisation, bisection on Sturm counts, and inverse iteration that
reorthogonalises within clusters of eigenvalues. These work on one d x d matrix,
whose size does not depend on the number of rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import materialize

LARGEST = 2**60  # larger whole numbers are taken for this one
_EPS = float(np.finfo(float).eps)
_RESULT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def tridiagonal(a: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Diagonal, off-diagonal and the orthogonal q with ``a = q t q'``, by Householder reflections."""
    a, n = a.astype(float).copy(), len(a)
    q = np.eye(n)
    for k in range(n - 2):
        v = a[k + 1 :, k].copy()
        if not v[1:].any():
            continue
        alpha = -math.copysign(float(np.linalg.norm(v)), v[0])
        v[0] -= alpha
        v /= np.linalg.norm(v)
        rest = a[k + 1 :, k + 1 :]
        p = rest @ v
        w = 2 * (p - (v @ p) * v)
        rest -= np.outer(v, w) + np.outer(w, v)
        a[k + 1 :, k] = a[k, k + 1 :] = 0
        a[k + 1, k] = a[k, k + 1] = alpha
        q[:, k + 1 :] -= 2 * np.outer(q[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), q


def sturm_counts(diagonal: np.ndarray, off: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Number of eigenvalues below each of ``at``: the negative pivots of the shifted matrix."""
    tiny = np.finfo(float).tiny / _EPS
    squares = off * off
    pivot = diagonal[0] - at
    below = (pivot < 0).astype(int)
    for d, s in zip(diagonal[1:], squares, strict=True):
        pivot = d - at - s / np.where(np.abs(pivot) < tiny, -tiny, pivot)
        below += pivot < 0
    return below


def leading_eigenvalues(diagonal: np.ndarray, off: np.ndarray, m: int) -> np.ndarray:
    """The m largest eigenvalues of a symmetric tridiagonal matrix, largest first, bisected to neighbouring doubles."""
    n = len(diagonal)
    reach = np.abs(np.concatenate([[0.0], off])) + np.abs(np.concatenate([off, [0.0]]))
    margin = _EPS * n * float((np.abs(diagonal) + reach).max()) + np.finfo(float).tiny
    low = np.full(m, (diagonal - reach).min() - margin)
    high = np.full(m, (diagonal + reach).max() + margin)
    rank = n - 1 - np.arange(m)  # so many eigenvalues are smaller
    while True:
        middle = low + (high - low) / 2
        open_ = (middle > low) & (middle < high) & (high - low > _EPS * np.maximum(np.abs(low), np.abs(high)))
        if not open_.any():
            return middle
        above = sturm_counts(diagonal, off, middle) > rank
        high, low = np.where(open_ & above, middle, high), np.where(open_ & ~above, middle, low)


def solve_shifted(diagonal: np.ndarray, off: np.ndarray, shift: float, b: np.ndarray, least: float) -> np.ndarray:
    """Solution of (t - shift) x = b by elimination with row exchanges; pivots below ``least`` are replaced by it."""
    n = len(diagonal)
    main, upper, second, x = diagonal - shift, np.append(off, 0.0), np.zeros(n), b.astype(float).copy()
    for i in range(n - 1):
        if abs(off[i]) <= abs(main[i]) or abs(off[i]) < least:
            main[i] = main[i] if abs(main[i]) >= least else least
            factor = off[i] / main[i]
            main[i + 1] -= factor * upper[i]
            x[i + 1] -= factor * x[i]
        else:
            factor = main[i] / off[i]
            main[i], upper[i], main[i + 1] = off[i], main[i + 1], upper[i] - factor * main[i + 1]
            second[i], upper[i + 1] = upper[i + 1], -factor * upper[i + 1]
            x[i], x[i + 1] = x[i + 1], x[i] - factor * x[i + 1]
    if abs(main[n - 1]) < least:
        main[n - 1] = least
    for i in range(n - 1, -1, -1):
        known = (upper[i] * x[i + 1] if i + 1 < n else 0.0) + (second[i] * x[i + 2] if i + 2 < n else 0.0)
        x[i] = (x[i] - known) / main[i]
    return x


def tridiagonal_vectors(diagonal: np.ndarray, off: np.ndarray, values: np.ndarray, steps: int = 6) -> np.ndarray:
    """Unit eigenvectors (columns) for eigenvalues in falling order.

    Eigenvalues closer than a thousandth of the matrix norm to their
    predecessor are of one cluster: their iterates are made orthogonal to those
    found before in it, at every step, and their shifts are kept apart.
    """
    n = len(diagonal)
    norm = float((np.abs(diagonal) + np.abs(np.append(off, 0.0)) + np.abs(np.insert(off, 0, 0.0))).max()) or 1.0
    rng, found, first, shift = np.random.default_rng(11), np.zeros((n, len(values))), 0, math.inf
    for j, value in enumerate(values):
        if j and values[j - 1] - value > 1e-3 * norm:
            first = j
        shift = min(float(value), shift - 4 * _EPS * norm) if j > first else float(value)
        x = rng.normal(size=n)
        for _ in range(steps):
            x = solve_shifted(diagonal, off, shift, x / np.abs(x).max(), _EPS * norm)
            for _ in range(2):
                x -= found[:, first:j] @ (found[:, first:j].T @ x)
            x /= np.linalg.norm(x)
        found[:, j] = x
    return found


def leading_components(covariance: np.ndarray, m: int) -> tuple[np.ndarray, np.ndarray]:
    """The m largest eigenvalues (falling) and their unit eigenvectors as columns; the largest entry of a vector is positive."""
    d = len(covariance)
    m = min(m, d)
    scale = float(np.abs(covariance).max()) if d else 0.0
    if scale == 0:
        return np.zeros(m), np.eye(d)[:, :m]
    diagonal, off, q = tridiagonal(covariance / scale)
    values = leading_eigenvalues(diagonal, off, m)
    vectors = q @ tridiagonal_vectors(diagonal, off, values)
    vectors, _ = np.linalg.qr(vectors) if m > 1 else (vectors / np.linalg.norm(vectors), None)
    signs = np.sign(vectors[np.abs(vectors).argmax(0), np.arange(m)])
    return values * scale, vectors * signs


class Whitener(NamedTuple):
    """What a dimension's projection needs: counts and sums of the distinct vectors, eigenpairs, trace, measured error."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    error: float = math.nan

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n: the whole part of the mean is taken off in integers."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        return (x - whole).astype(float) - np.array([s % self.n / self.n for s in self.sums])

    def white(self, x: np.ndarray) -> np.ndarray:
        """Projections over the roots of the eigenvalues; 0 on a component without variance."""
        seen = self.values > _EPS * len(self.sums) * max(self.values[0], 0.0)
        return self.centred(x) @ self.vectors * np.where(seen, 1 / np.sqrt(np.where(seen, self.values, 1.0)), 0.0)

    def deviations(self, x: np.ndarray) -> pa.Array:
        """Exact sums of (n * x - S)^2; null where they exceed a long."""
        about = ((self.centred(x) * self.n) ** 2).sum(1)
        wrap = 2**64
        sums = np.array([s % wrap for s in self.sums], np.uint64)
        off = x.astype(np.uint64) * np.uint64(self.n % wrap) - sums  # modulo 2^64, as are squares and sums
        return pa.array((off * off).sum(1, dtype=np.uint64).astype(np.int64), mask=about >= 2.0**63)


def whole_vectors(vectors: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """``(vec_id, dim, x)`` of the vectors with components, none null or non-finite; x is floor(scale * component)."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    finite = F.forall(v, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(v, lambda c: F.floor(F.greatest(F.least(c * scale, F.lit(float(LARGEST))), F.lit(-float(LARGEST)))))
    return rows.where(v.isNotNull() & (F.size(v) > 0) & finite).select("vec_id", F.size(v).alias("dim"), whole.alias("x"))


def _by_dim(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows, matrix) for each dimension in each batch of columns dim and x."""
    for batch in batches:
        dims, column = batch.column("dim").to_numpy(), batch.column("x")
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            some = column if len(at) == len(dims) else column.take(pa.array(at))
            yield int(dim), at, some.flatten().to_numpy().reshape(len(at), int(dim)).astype(np.int64)


def dimension_sums(fit: DataFrame) -> dict[int, tuple[int, list[int]]]:
    """Number of vectors and exact sums per place, for each dimension. A task gives one row per place."""

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, list] = {}
        for dim, at, x in _by_dim(batches):
            n, high, low = totals.setdefault(dim, [0, np.zeros(dim, np.int64), np.zeros(dim, np.int64)])
            totals[dim] = [n + len(at), high + (x >> 32).sum(0), low + (x & 0xFFFFFFFF).sum(0)]
        for dim, (n, high, low) in totals.items():
            columns = np.full(dim, dim, np.int32), np.arange(dim, dtype=np.int32), np.full(dim, n, np.int64), high, low
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["dim", "place", "n", "high", "low"])

    parts = fit.mapInArrow(sums, "dim int, place int, n long, high long, low long")
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    found: dict[int, tuple[int, list[int]]] = {}
    for r in parts.groupBy("dim", "place").agg(F.sum("n").alias("n"), *exact).orderBy("dim", "place").collect():
        found.setdefault(r["dim"], (r["n"], []))[1].append((int(r["high"]) << 32) + int(r["low"]))
    return found


def covariances(fit: DataFrame, totals: dict[int, tuple[int, list[int]]]) -> dict[int, np.ndarray]:
    """The covariance per dimension, divisor n, of centred vectors. A task gives one row per place; these are added exactly."""
    centre = {dim: Whitener(n, sums, np.empty(0), np.empty(0), 0.0) for dim, (n, sums) in totals.items()}

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for dim, _, x in _by_dim(batches):
            y = centre[dim].centred(x)
            sums[dim] = sums.get(dim, 0.0) + y.T @ y
        for dim, matrix in sums.items():
            columns = [pa.array(np.full(dim, dim, np.int32)), pa.array(np.arange(dim, dtype=np.int32)), pa.array(list(matrix))]
            yield pa.RecordBatch.from_arrays(columns, names=["dim", "place", "products"])

    def added(parts: pd.DataFrame) -> pd.DataFrame:
        total = [math.fsum(c) for c in zip(*parts["products"], strict=True)]
        return pd.DataFrame({"dim": parts["dim"].iloc[:1], "place": parts["place"].iloc[:1], "products": [total]})

    schema = "dim int, place int, products array<double>"
    found: dict[int, np.ndarray] = {dim: np.zeros((dim, dim)) for dim in totals}
    for r in fit.mapInArrow(products, schema).groupBy("dim", "place").applyInPandas(added, schema).collect():
        found[r["dim"]][r["place"]] = r["products"]
    return {dim: (m + m.T) / 2 / totals[dim][0] for dim, m in found.items()}


def merged_moments(a: tuple, b: tuple) -> tuple:
    """Count, mean and centred products of two sets together."""
    n = a[0] + b[0]
    gap = b[1] - a[1]
    return n, a[1] + gap * (b[0] / n), a[2] + b[2] + np.outer(gap, gap) * (a[0] * b[0] / n)


def identity_errors(fit: DataFrame, models: dict[int, Whitener]) -> dict[int, float]:
    """Largest entry of the whitened vectors' covariance minus the identity, measured on all distinct vectors."""

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for dim, at, x in _by_dim(batches):
            z = models[dim].white(x)
            mean = z.mean(0)
            part = len(at), mean, (z - mean).T @ (z - mean)
            held[dim] = merged_moments(held[dim], part) if dim in held else part
        for dim, (n, mean, products) in held.items():
            columns = [pa.array([dim], pa.int32()), pa.array([n], pa.int64()), pa.array([mean]), pa.array([products.ravel()])]
            yield pa.RecordBatch.from_arrays(columns, names=["dim", "n", "mean", "products"])

    def error(parts: pd.DataFrame) -> pd.DataFrame:
        m, all_ = len(parts["mean"].iloc[0]), None
        for n, mean, products in zip(parts["n"], parts["mean"], parts["products"], strict=True):
            part = int(n), np.array(mean), np.array(products).reshape(m, m)
            all_ = part if all_ is None else merged_moments(all_, part)
        off = np.abs(all_[2] / all_[0] - np.eye(m)).max()
        return pd.DataFrame({"dim": parts["dim"].iloc[:1], "error": [float(off)]})

    parts = fit.mapInArrow(moments, "dim int, n long, mean array<double>, products array<double>")
    return {r["dim"]: r["error"] for r in parts.groupBy("dim").applyInPandas(error, "dim int, error double").collect()}


def fit_whiteners(fit: DataFrame, components: int) -> dict[int, Whitener]:
    """A whitener for each dimension of ``fit(dim, x)``, which holds every distinct vector once."""
    totals = dimension_sums(fit)
    models = {}
    for dim, covariance in covariances(fit, totals).items():
        values, vectors = leading_components(covariance, components)
        models[dim] = Whitener(*totals[dim], values, vectors, float(np.trace(covariance)))
    errors = identity_errors(fit, models) if models else {}
    return {dim: model._replace(error=errors[dim]) for dim, model in models.items()}


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = 4, scale: int = 256) -> DataFrame:
    """``(vec_id, component, n, deviation, whitened, explained, identity_error)`` per vector and component.

    Vectors that are null, without components, or hold nulls, NaN or infinities
    take no part. Vectors of different dimensions are not comparable: each
    dimension has a fit of its own (the driver holds one d x d matrix for each).
    With fewer dimensions than ``components`` there are as many components as
    dimensions. Repeated vectors count once in the fit, but every row is
    returned, also rows without an id. A component without variance (one
    distinct vector, say) has whitened 0 and explained 0. ``deviation`` is null
    where it exceeds a long; whole numbers beyond ``LARGEST`` are cut to it. An
    empty table gives no rows.
    """
    rows = materialize(whole_vectors(vectors, id_col, vector_col, scale), "white-rows")
    fit = materialize(rows.select("dim", "x").distinct(), "white-fit")
    models = vectors.sparkSession.sparkContext.broadcast(fit_whiteners(fit, components))

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, at, x in _by_dim([batch]):
                model = models.value[dim]
                m = len(model.values)
                explained = np.maximum(model.values, 0.0) / model.trace if model.trace > 0 else np.zeros(m)
                every = pa.array(np.repeat(np.arange(len(at)), m))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("vec_id").take(pa.array(np.repeat(at, m))),
                        pa.array(np.tile(np.arange(1, m + 1, dtype=np.int32), len(at))),
                        pa.array(np.full(len(at) * m, model.n, np.int64)),
                        model.deviations(x).take(every),
                        pa.array(model.white(x).ravel()),
                        pa.array(np.tile(explained, len(at))),
                        pa.array(np.full(len(at) * m, model.error)),
                    ],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return rows.mapInArrow(project, _RESULT)
