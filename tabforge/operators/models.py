"""Regression models with Spark ML, with the penalty scales of the usual textbook forms.

A training table has ``features``, ``label`` and, for searches, a ``fold``
column. Every ``fit_*`` returns the fitted model; ``predict_splits`` scores a
table that also has ``split``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark import StorageLevel
from pyspark.ml import Model
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    LinearRegression,
    LinearRegressionModel,
    RandomForestRegressor,
)
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.hashing import bucket
from tabforge.operators import boosting as G
from tabforge.session import materialize, setting

MAX_DEPTH = 30
TASK_BYTES = 16 * 2**20  # of stored rows in a task of a tree fit; their bins, which Spark keeps, take over ten times as much


def small_tasks(train: DataFrame):
    """Scans inside the block are cut into tasks of ``TASK_BYTES``."""
    return setting(train.sparkSession, "spark.sql.files.maxPartitionBytes", TASK_BYTES)


@contextmanager
def kept_rows(train: DataFrame) -> Iterator[DataFrame]:
    """``train`` inside the block, read from the disks of the executors instead of being decoded from its files by every pass.

    The rows take no memory of the fits, and a lost part is read again from the
    files. They lie in the tasks of a tree fit, so Spark's trees draw the same.
    A table that is persisted already stays as it is.
    """
    if train.storageLevel != StorageLevel.NONE:
        yield train
        return
    rows = train.persist(StorageLevel.DISK_ONLY)
    try:
        with small_tasks(train):
            rows.count()
        yield rows
    finally:
        rows.unpersist()


def fit_trees(estimator, train: DataFrame, params: dict | None = None) -> Model:
    """The fit of a tree estimator, whose tasks keep what they read: their rows stay as few when the table grows."""
    with small_tasks(train):
        return estimator.fit(train, params)


def fold_column(key: str | Column, folds: int, seed: int = 42) -> Column:
    """Fold number from the row key; a salt of its own keeps it independent of the split."""
    return bucket(key, f"fold-{seed}", folds)


def fit_linear(train: DataFrame) -> LinearRegressionModel:
    """Ordinary least squares; the normal equations are one pass over the rows."""
    return LinearRegression(regParam=0.0, solver=_solver(train)).fit(train)


def _solver(train: DataFrame) -> str:
    """Normal equations up to Spark's limit of 4096 features, iterations beyond."""
    first = train.select("features").first()
    return "normal" if first is not None and first[0].size <= 4096 else "l-bfgs"


def fit_ridge(train: DataFrame, alpha: float) -> LinearRegressionModel:
    """Minimises ``|y - Xw|^2 + alpha |w|^2`` (intercept free).

    Spark divides the squared error by 2n and scales the label by its std
    before the penalty, so the same problem needs ``alpha * std(y) / n``.
    """
    solver = _solver(train)
    spread = F.stddev_pop if solver == "normal" else F.stddev_samp
    n, std = train.agg(F.count("label"), spread("label")).first()
    reg = alpha * (std or 1.0) / n
    return LinearRegression(
        regParam=reg, elasticNetParam=0.0, standardization=False, solver=solver, maxIter=1000, tol=1e-10
    ).fit(train)


def fit_lasso(train: DataFrame, alpha: float, max_iter: int = 5000) -> LinearRegressionModel:
    """Minimises ``|y - Xw|^2 / 2n + alpha |w|_1``.

    The normal solver reads the rows once and iterates on their d x d summary.
    """
    return LinearRegression(
        regParam=alpha,
        elasticNetParam=1.0,
        standardization=False,
        solver=_solver(train),
        maxIter=max_iter,
        tol=1e-10,
    ).fit(train)


def fit_tree(train: DataFrame, max_depth: int = 5, min_leaf: int = 1, seed: int = 42) -> Model:
    """Decision tree. Spark has no minimum size for a split, only for a leaf."""
    return fit_trees(DecisionTreeRegressor(maxDepth=_depth(max_depth), minInstancesPerNode=min_leaf, seed=seed), train)


def _depth(depth: int | None) -> int:
    """Unlimited depth becomes the deepest tree Spark grows; a deeper one cannot be asked for."""
    if depth is not None and depth > MAX_DEPTH:
        raise ValueError(f"Spark grows trees to depth {MAX_DEPTH}, not {depth}")
    return MAX_DEPTH if depth is None else depth


def fit_forest(
    train: DataFrame,
    trees: int = 200,
    max_depth: int | None = 15,
    min_leaf: int = 1,
    features: str = "auto",
    seed: int = 42,
) -> Model:
    forest = RandomForestRegressor(
        numTrees=trees,
        maxDepth=_depth(max_depth),
        minInstancesPerNode=min_leaf,
        featureSubsetStrategy=str(features),
        seed=seed,
    )
    return fit_trees(forest, train)


def fit_gbt(
    train: DataFrame | G.StoredRows,
    trees: int = 300,
    rate: float = 0.05,
    max_depth: int = 6,
    rows: float = 0.8,
    features: str = "all",
    min_leaf: int = 1,
    seed: int = 42,
    l1: float = 0.0,
    l2: float = 0.0,
    patience: int | None = None,
    tasks: int | None = None,
) -> G.Boosted:
    """Gradient boosting on the squared error, with all ``trees`` or, on stored rows with validation rows, as ``patience`` says.

    Each tree sees a share of the ``rows`` and of the ``features``. ``l1`` and ``l2`` shrink the leaves.
    """
    stored = train if isinstance(train, G.StoredRows) else G.boosting_rows(train)
    size = stored.rows.size if stored.rows else 1
    config = G.BoostingConfig(
        trees, rate, max_depth, rows, _share(features, size), l1, l2, 0.0, min_leaf=min_leaf, patience=patience or trees, seed=seed
    )
    return G.fit_rounds(stored, config, tasks, patience is not None)


def _share(features: str, size: int) -> float:
    """A strategy for subsets of features, as Spark names them, as a share."""
    named = {"all": 1.0, "auto": 1.0, "sqrt": size**-0.5, "log2": math.log2(max(size, 2)) / size, "onethird": 1 / 3}
    if str(features) in named:
        return min(1.0, named[str(features)])
    number = float(features)
    return min(1.0, number / size if str(features).isdigit() and number >= 1 else number)


def fit_bagged(
    train: DataFrame, trees: int = 200, max_depth: int = 8, min_leaf: int = 1, features: str = "all", seed: int = 42
) -> G.Boosted:
    """A random forest on stored bins: trees on rows drawn with repetition, a share of the ``features`` for each node."""
    stored = G.boosting_rows(train)
    config = G.BoostingConfig(
        trees, 1 / trees, max_depth, 1.0, 1.0, 0.0, 0.0, 0.0, min_leaf=min_leaf, patience=trees, seed=seed,
        bagged=True, node_columns=_share(features, stored.rows.size if stored.rows else 1),
    )
    return G.fit_rounds(stored, config, cut=False)


@dataclass
class EarlyStopped:
    model: G.Boosted
    best_iteration: int
    val_rmse: float
    full: G.Boosted | None  # with all rounds, if all were fitted


def best_iteration(losses: list[float], patience: int) -> int:
    """Number of rounds to keep: the best one before ``patience`` rounds in a row bring nothing better."""
    best = 0
    for i, loss in enumerate(losses):
        if loss < losses[best]:
            best = i
        elif i - best >= patience:
            break
    return best + 1


def fit_gbt_early_stop(
    train: DataFrame | G.StoredRows,
    val: DataFrame,
    trees: int = 500,
    rate: float = 0.03,
    max_depth: int = 7,
    rows: float = 0.8,
    features: str = "0.8",
    min_leaf: int = 1,
    patience: int = 50,
    seed: int = 42,
    l1: float = 0.0,
    l2: float = 1.0,
    tasks: int | None = None,
) -> EarlyStopped:
    """Boosting cut at its best iteration on the validation rows.

    The fit ends once ``patience`` rounds brought nothing better, and the trees up to the best round are the model.
    ``train`` can be stored rows that hold those of ``val`` already.
    """
    stored = train if isinstance(train, G.StoredRows) else G.boosting_rows(train, val)
    options = {"rate": rate, "max_depth": max_depth, "rows": rows, "features": features, "min_leaf": min_leaf, "seed": seed}
    found = fit_gbt(stored, trees, **options, l1=l1, l2=l2, patience=patience, tasks=tasks)
    full = replace(found, trees=found.grown) if len(found.grown) == trees else None
    loss = found.losses[found.best_iteration - 1][1] if found.losses else math.nan
    return EarlyStopped(found, found.best_iteration, loss**0.5, full)


def predict_splits(model: Model, data: DataFrame, name: str, keys: tuple[str, ...] = ()) -> DataFrame:
    scored = model.transform(data)
    return scored.select(F.lit(name).alias("model"), *keys, "split", "label", "prediction")


def predictions_side_by_side(models: dict[str, Model], data: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, label, model, prediction)`` of many models from one pass over the rows."""
    out = data
    for i, model in enumerate(models.values()):
        out = model.copy({model.predictionCol: f"_p{i}"}).transform(out)
    places = [f"_p{i}" for i in range(len(models))]
    long = out.select(*keys, "label", *places).unpivot([*keys, "label"], places, "model", "prediction")
    names = F.create_map(*[F.lit(x) for pair in zip(places, models, strict=True) for x in pair])
    return long.withColumn("model", names[F.col("model")])


# --- stacking -------------------------------------------------------------


@dataclass
class Stacked:
    """Base models refit on all training rows under a linear blend."""

    bases: dict[str, Model]
    blend: LinearRegressionModel

    def transform(self, data: DataFrame) -> DataFrame:
        return self.blend.transform(_blend_input(self.bases, data)).drop("_columns")

    @property
    def weights(self) -> dict[str, float]:
        return dict(zip(self.bases, self.blend.coefficients.toArray().tolist(), strict=True))


def _blend_input(bases: dict[str, Model], data: DataFrame) -> DataFrame:
    out = data
    for name, model in bases.items():
        scored = model.copy({model.predictionCol: f"_p_{name}"}).transform(out)
        out = scored
    names = [f"_p_{n}" for n in bases]
    blended = VectorAssembler(inputCols=names, outputCol="_columns").transform(out).drop(*names)
    return blended.withColumnRenamed("features", "_features").withColumnRenamed("_columns", "features")


def fit_stacking(train: DataFrame, base_fits: dict, folds: int = 3, alpha: float = 1.0) -> Stacked:
    """Blend fitted on out-of-fold predictions; ``base_fits`` maps a name to ``fit(train) -> model``.

    ``train`` needs a ``fold`` column with values ``0 .. folds - 1``.
    """
    with kept_rows(train) as rows:
        parts = []
        for k in range(folds):
            models = {n: fit(rows.where(F.col("fold") != k)) for n, fit in base_fits.items()}
            held = _blend_input(models, rows.where(F.col("fold") == k))
            parts.append(held.select("features", "label"))
        unseen = parts[0]
        for part in parts[1:]:
            unseen = unseen.unionByName(part)
        # The blend passes over these rows more than once: store them instead of scoring again.
        blend = fit_ridge(materialize(unseen, "out-of-fold"), alpha)
        return Stacked({n: fit(rows) for n, fit in base_fits.items()}, blend)
