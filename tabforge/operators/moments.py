"""Linear models from sums of products.

One scan gives, for every cell of rows (a fold, a share of the rows, a split),
the matrix of sums of z z' with z = (1, features, label). Matrices of disjoint
cells add up, so the training rows of any fold, share or split are a sum of
cells, and every fit and every squared error follows from such a sum without
reading the rows again. Features should be scaled, as those of the feature flow
are: sums of squares lose digits when means are far larger than deviations.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

Cells = dict[tuple[int, ...], np.ndarray]


class Line(NamedTuple):
    """A fitted linear model."""

    intercept: float
    coefficients: np.ndarray


def product_sums(rows: DataFrame, by: list[str], features: str | list[str] = "features", label: str = "label") -> Cells:
    """The matrix of each cell, by the values of the integer columns ``by``.

    ``features`` is a vector column or a list of numeric columns; rows without a
    label or with a missing feature are left out. A task holds one matrix per
    cell and gives one row per matrix row; these are added exactly. The driver
    gets the matrices, whose size depends on the features and cells alone.
    """
    x = F.when(F.col(features).isNotNull(), vector_to_array(features)) if isinstance(features, str) else F.array(*[F.col(f).cast("double") for f in features])
    slim = rows.select(*[F.col(c).cast("long").alias(f"_b{i}") for i, c in enumerate(by)], x.alias("_x"), F.col(label).cast("double").alias("_y"))
    slim = slim.where("_x IS NOT NULL AND _y IS NOT NULL AND NOT isnan(_y) AND NOT exists(_x, v -> v IS NULL OR isnan(v))")
    keys = [f"_b{i}" for i in range(len(by))]

    def products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Cells = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            table = np.column_stack([np.ones(batch.num_rows), batch.column("_x").flatten().to_numpy().reshape(batch.num_rows, -1), batch.column("_y").to_numpy()])
            cells = np.column_stack([np.zeros(batch.num_rows, np.int64), *[batch.column(k).to_numpy() for k in keys]])
            names, place = np.unique(cells, axis=0, return_inverse=True)
            for i, name in enumerate(names):
                some = table[place.ravel() == i]
                key = tuple(int(v) for v in name[1:])
                held[key] = held.get(key, 0.0) + some.T @ some
        for key, matrix in held.items():
            columns = [pa.array(np.full(len(matrix), v, np.int64)) for v in key]
            columns += [pa.array(np.arange(len(matrix), dtype=np.int32)), pa.array(list(matrix))]
            yield pa.RecordBatch.from_arrays(columns, names=[*keys, "place", "products"])

    def added(parts: pd.DataFrame) -> pd.DataFrame:
        first = parts.iloc[:1].copy()
        first["products"] = [[math.fsum(c) for c in zip(*parts["products"], strict=True)]]
        return first

    schema = ", ".join([*[f"{k} long" for k in keys], "place int", "products array<double>"])
    found: dict[tuple[int, ...], dict[int, list[float]]] = {}
    for r in slim.mapInArrow(products, schema).groupBy(*keys, "place").applyInPandas(added, schema).collect():
        found.setdefault(tuple(r[k] for k in keys), {})[r["place"]] = r["products"]
    return {key: np.array([matrix[i] for i in range(len(matrix))]) for key, matrix in found.items()}


def total(cells: Cells, where: Callable[..., bool]) -> np.ndarray:
    """The matrix of all cells that ``where(*key)`` takes; None stands for no row."""
    return sum((m for key, m in cells.items() if where(*key)), np.zeros(()))


def _centred(sums: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Rows, means and covariance (divisor n) of features and label."""
    n = sums[0, 0]
    mean = sums[0, 1:] / n
    return n, mean, sums[1:, 1:] / n - np.outer(mean, mean)


def _line(mean: np.ndarray, coefficients: np.ndarray) -> Line:
    return Line(float(mean[-1] - mean[:-1] @ coefficients), coefficients)


def solve_linear(sums: np.ndarray, alpha: float = 0.0) -> Line:
    """Least squares; of several solutions the shortest."""
    _, mean, cov = _centred(sums)
    return _line(mean, np.linalg.lstsq(cov[:-1, :-1], cov[:-1, -1], rcond=1e-12)[0])


def solve_ridge(sums: np.ndarray, alpha: float) -> Line:
    """Minimises ``|y - Xw|^2 + alpha |w|^2`` (intercept free)."""
    if alpha == 0:
        return solve_linear(sums)
    n, mean, cov = _centred(sums)
    return _line(mean, np.linalg.solve(cov[:-1, :-1] + alpha / n * np.eye(len(cov) - 1), cov[:-1, -1]))


def solve_lasso(sums: np.ndarray, alpha: float, max_iter: int = 5000, tol: float = 1e-12) -> Line:
    """Minimises ``|y - Xw|^2 / 2n + alpha |w|_1`` by coordinate descent on the sums."""
    _, mean, cov = _centred(sums)
    xx, xy = cov[:-1, :-1], cov[:-1, -1]
    w, moved = np.zeros(len(xy)), xy.copy()  # moved = xy - xx @ w
    scale = float(np.sqrt(max(cov[-1, -1], 0.0))) or 1.0
    for _ in range(max_iter):
        most = 0.0
        for j in range(len(w)):
            if xx[j, j] <= 0:
                continue
            pull = moved[j] + xx[j, j] * w[j]
            new = math.copysign(max(abs(pull) - alpha, 0.0), pull) / xx[j, j]
            if new != w[j]:
                moved -= xx[:, j] * (new - w[j])
                most = max(most, abs(new - w[j]) * math.sqrt(xx[j, j]))
                w[j] = new
        if most <= tol * scale:
            break
    return _line(mean, w)


SOLVERS: dict[str, Callable[[np.ndarray, float], Line]] = {"linear": solve_linear, "ridge": solve_ridge, "lasso": solve_lasso}


def squared_error(sums: np.ndarray, line: Line) -> float:
    """Sum of squared residuals of the rows behind ``sums``."""
    v = np.concatenate([[-line.intercept], -line.coefficients, [1.0]])
    return max(float(v @ sums @ v), 0.0)


def rmse(sums: np.ndarray, line: Line) -> float:
    return math.sqrt(squared_error(sums, line) / sums[0, 0])


def r2(sums: np.ndarray, line: Line) -> float | None:
    """None for rows that all have the same label."""
    spread = float(sums[-1, -1] - sums[0, -1] ** 2 / sums[0, 0])
    return 1 - squared_error(sums, line) / spread if spread > 0 else None


def cross_validated(cells: Cells, kind: str, alphas: list[float]) -> list[tuple[float, float]]:
    """``(alpha, mean rmse over the folds)`` from cells by fold. A fold without rows is passed over."""
    folds = sorted(key[0] for key in cells)
    held = {k: (total(cells, lambda f, k=k: f != k), cells[k,]) for k in folds}
    usable = [pair for pair in held.values() if pair[0].ndim]
    if not usable:
        return []
    return [(alpha, math.fsum(rmse(out, SOLVERS[kind](rest, alpha)) for rest, out in usable) / len(usable)) for alpha in alphas]


def path_rows(train: np.ndarray, val: np.ndarray, alphas: list[float]) -> list[tuple[str, float, str, float | None]]:
    """``(model, alpha, split, r2)`` of ridge and lasso fitted on ``train``."""
    rows = []
    for kind in ("lasso", "ridge"):
        for alpha in alphas:
            line = SOLVERS[kind](train, alpha)
            rows += [(kind, float(alpha), name, r2(sums, line)) for name, sums in (("train", train), ("val", val)) if sums.ndim]
    return rows


def curve_rows(cells: Cells, kind: str, alpha: float, steps: int) -> list[tuple[int, int, int, float | None, float | None]]:
    """``(step, fold, training rows, train r2, validation r2)`` from cells by (fold, step).

    A row of step s belongs to the training rows of all steps from s on; the
    validation rows of a fold are all of its rows.
    """
    rows = []
    for step in range(steps):
        for k in sorted({key[0] for key in cells}):
            train = total(cells, lambda f, s, k=k, step=step: f != k and s <= step)
            val = total(cells, lambda f, s, k=k: f == k)
            if train.ndim and val.ndim:
                line = SOLVERS[kind](train, alpha)
                rows.append((step, k, int(round(train[0, 0])), r2(train, line), r2(val, line)))
    return rows
