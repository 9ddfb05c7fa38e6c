"""Second-order boosting and regression trees on histograms.

Features are cut into bins once. Boosting stores its rows as packed bins and
grows all trees in one stage (``histograms``). A single regression tree takes a
scan per level, in which every task adds up gradients, hessians and rows per
(node, feature, bin); the sums of a node meet in one group, whose size depends
on the features and bins alone, and only its best split reaches the driver.
Leaf weights follow from the sums with L1 and L2 penalties.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector, Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.operators import histograms as H
from tabforge.session import materialize


ROW_GROUP = 4 * 2**20  # bytes; bins take little room, and a small file should still be shared among tasks


@dataclass(frozen=True)
class BoostingConfig:
    """Settings. ``rows`` and ``columns`` are the shares that a tree sees; ``l1``, ``l2``, ``min_weight`` (hessians of a
    child) and ``min_gain`` restrain the leaves, ``min_split`` and ``min_leaf`` are numbers of rows. ``patience`` rounds
    without a better validation loss end the fit. ``bagged`` trees are those of a forest: each fits the label on rows drawn
    with repetition, and with a ``rate`` of one by their number the sum is their mean; ``node_columns`` is the share of
    features drawn for each node."""

    rounds: int = 500
    rate: float = 0.03
    max_depth: int = 7
    rows: float = 0.8
    columns: float = 0.8
    l1: float = 0.0
    l2: float = 1.0
    min_weight: float = 1.0
    min_gain: float = 0.0
    min_split: int = 2
    min_leaf: int = 1
    bins: int = 64
    patience: int = 50
    store_every: int = 10
    seed: int = 42
    bagged: bool = False
    node_columns: float = 1.0


@dataclass
class Tree:
    """Nodes as lists: feature (-1: leaf), upper bound of the left side, children, weight and the gain of the split."""

    feature: list[int] = field(default_factory=lambda: [-1])
    bound: list[float] = field(default_factory=lambda: [0.0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    weight: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])

    def split(self, node: int, feature: int, bound: float, gain: float) -> tuple[int, int]:
        children = len(self.feature), len(self.feature) + 1
        self.feature[node], self.bound[node], self.gain[node] = feature, bound, gain
        self.left[node], self.right[node] = children
        for values, fresh in ((self.feature, -1), (self.bound, 0.0), (self.left, -1), (self.right, -1), (self.weight, 0.0), (self.gain, 0.0)):
            values += [fresh, fresh]
        return children

    def nodes_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row of a matrix."""
        feature, bound, children = np.array(self.feature), np.array(self.bound), np.array([self.left, self.right])
        at = np.zeros(len(x), np.int64)
        while (inner := np.flatnonzero(feature[at] >= 0)).size:
            nodes = at[inner]
            at[inner] = children[(x[inner, feature[nodes]] > bound[nodes]).astype(int), nodes]
        return at

    def predict(self, x: np.ndarray) -> np.ndarray:
        return np.array(self.weight)[self.nodes_of(x)]

    def cut(self, depth: int) -> Tree:
        """The tree grown to a smaller depth: the same splits, whose nodes end there as leaves."""
        out = replace(self, feature=list(self.feature))
        level = [0]
        for _ in range(depth):
            level = [c for n in level if self.feature[n] >= 0 for c in (self.left[n], self.right[n])]
        for n in level:
            out.feature[n] = -1
        return out


class _Scorer:
    """Sums of trees for many rows at once.

    A feature's value is the number of bounds below it. By that number a table per tree says which leaves stay possible;
    the leftmost of those that stay by all features is the row's leaf.
    """

    def __init__(self, trees: list[Tree]):
        used: dict[int, set[float]] = {}
        for t in trees:
            for f, b in zip(t.feature, t.bound, strict=True):
                if f >= 0:
                    used.setdefault(f, set()).add(b)
        self.bounds = {f: np.array(sorted(b)) for f, b in used.items()}
        self.trees = [self._tables(t) for t in trees]

    def _tables(self, tree: Tree) -> tuple[dict[int, np.ndarray], np.ndarray]:
        spans, leaves, stack = {}, [], [(0, False)]
        while stack:  # leaves from left to right, and the span of those on the left of each inner node
            node, passed = stack.pop()
            if tree.feature[node] < 0:
                leaves.append(tree.weight[node])
            elif passed:
                spans[node] = (spans[node], len(leaves))
            else:
                spans[node] = len(leaves)
                stack += [(tree.right[node], False), (node, True), (tree.left[node], False)]
        words, every = -(-len(leaves) // 64), 2**64 - 1
        tables = {}
        for node, (a, b) in spans.items():
            f = tree.feature[node]
            if f not in tables:
                tables[f] = np.full((words, len(self.bounds[f]) + 1), every, np.uint64)
            gone = ((1 << b) - (1 << a)) if b > a else 0
            after = int(np.searchsorted(self.bounds[f], tree.bound[node])) + 1
            for w in range(a // 64, (b - 1) // 64 + 1):
                tables[f][w, after:] &= np.uint64(every & ~(gone >> (64 * w)))
        return tables, np.array(leaves)

    def __call__(self, x: np.ndarray, rows: int = 2**14) -> np.ndarray:
        return np.concatenate([self._some(x[i : i + rows]) for i in range(0, len(x), rows)] or [np.zeros(0)])

    def _some(self, x: np.ndarray) -> np.ndarray:
        out, codes = np.zeros(len(x)), {}
        for f, bounds in self.bounds.items():
            codes[f] = np.searchsorted(bounds, x[:, f], side="left")
            codes[f][np.isnan(x[:, f])] = 0
        for tables, leaves in self.trees:
            at, left = None, None
            for w in range(-(-len(leaves) // 64)):
                stay = np.full(len(x), 2**64 - 1, np.uint64)
                for f, table in tables.items():
                    stay &= table[w].take(codes[f])
                first = (stay & (~stay + np.uint64(1))).astype(np.float64)  # the lowest bit, whose exponent is its place
                place = (first.view(np.int64) >> 52) - 1023 + 64 * w
                if at is None:
                    at, left = place, stay == 0
                else:
                    at, left = np.where(left, place, at), left & (stay == 0)
            out += leaves.take(at)
        return out


@dataclass
class Boosted:
    """A sum of trees over a start value."""

    start: float
    trees: list[Tree]
    losses: list[tuple[float, float]]  # training and validation mean squared error after each round
    best_iteration: int
    size: int = 0  # number of features
    grown: list[Tree] = field(default_factory=list)  # the trees of all rounds
    prediction: str = "prediction"
    predictionCol = "prediction"

    @property
    def getNumTrees(self) -> int:
        return len(self.trees)

    @property
    def featureImportances(self) -> DenseVector:
        return Vectors.dense(self.importances(self.size))

    def copy(self, extra: dict) -> Boosted:
        """The model under another name of its ``predictionCol``."""
        return replace(self, prediction=extra.get(self.predictionCol, self.prediction))

    def predict(self, x: np.ndarray) -> np.ndarray:
        return self.start + _Scorer(self.trees)(x)

    def transform(self, data: DataFrame, features: str = "features") -> DataFrame:
        """``data`` with ``prediction``; null features give null."""
        start, score = self.start, _Scorer(self.trees)

        @F.arrow_udf("double")
        def predicted(x: pa.Array) -> pa.Array:
            known = x.is_valid().to_numpy(zero_copy_only=False)
            out = np.zeros(len(x))
            if known.any():
                out[known] = start + score(x.flatten().to_numpy().reshape(int(known.sum()), -1))
            return pa.array(out, mask=~known)

        return data.withColumn(self.prediction, predicted(_numbers(features)))

    def importances(self, size: int) -> np.ndarray:
        """Share of the gain by feature."""
        total = np.zeros(size)
        for t in self.trees:
            for f, g in zip(t.feature, t.gain, strict=True):
                total[f] += g if f >= 0 else 0.0
        return total / total.sum() if total.sum() > 0 else total


def bin_bounds(rows: DataFrame, size: int, bins: int, only: list[int] | None = None) -> list[np.ndarray]:
    """Upper bounds of the bins of each of ``size`` features, or of ``only`` some (all but the last bin), at quantiles of all rows."""
    features = list(range(size)) if only is None else only
    if not features:
        return []
    probs = F.array(*[F.lit((i + 1) / bins) for i in range(bins - 1)])
    row = rows.agg(*[F.percentile_approx(F.get("_x", i), probs, F.lit(20 * bins)).alias(f"q{i}") for i in features], *[F.max(F.get("_x", i)).alias(f"m{i}") for i in features]).first()
    return [np.array(sorted({q for q in row[f"q{i}"] or [] if q < row[f"m{i}"]})) for i in features]


def leaf_weight(g: float, h: float, l1: float, l2: float) -> float:
    """The weight that minimises g w + (h + l2) w^2 / 2 + l1 |w|."""
    return -math.copysign(max(abs(g) - l1, 0.0), g) / (h + l2) if h + l2 > 0 else 0.0


def best_split(g: np.ndarray, h: np.ndarray, n: np.ndarray, config: BoostingConfig) -> tuple[int, int, float, float, float] | None:
    """``(feature, last bin of the left side, gain, left g, left h)`` of a node from its sums (features x bins); ties to the first."""

    def quality(g: np.ndarray, h: np.ndarray) -> np.ndarray:
        return np.maximum(np.abs(g) - config.l1, 0) ** 2 / np.maximum(h + config.l2, 1e-300)

    total_g, total_h, rows = g[0].sum(), h[0].sum(), n[0].sum()
    if rows < config.min_split:
        return None
    gl, hl, nl = np.cumsum(g, 1)[:, :-1], np.cumsum(h, 1)[:, :-1], np.cumsum(n, 1)[:, :-1]
    gr, hr, nr = total_g - gl, total_h - hl, rows - nl
    gain = (quality(gl, hl) + quality(gr, hr) - quality(total_g, total_h)) / 2
    fits = (nl >= max(1, config.min_leaf)) & (nr >= max(1, config.min_leaf)) & (hl >= config.min_weight) & (hr >= config.min_weight)
    gain = np.where(fits, gain, -np.inf)
    if not gain.size or not gain.max() > config.min_gain + 1e-12 * abs(quality(total_g, total_h)):
        return None
    f, b = np.unravel_index(gain.argmax(), gain.shape)
    return int(f), int(b), float(gain[f, b]), float(gl[f, b]), float(hl[f, b])


def _numbers(features: str) -> Column:
    """A vector column as an array, null for null."""
    return F.when(F.col(features).isNotNull(), vector_to_array(features))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return batch.column("_x").flatten().to_numpy().reshape(batch.num_rows, -1)


def _code_type(bounds: list[np.ndarray]) -> type:
    return np.int8 if max(map(len, bounds), default=0) <= 127 else np.int16


def binned(state: DataFrame, bounds: list[np.ndarray]) -> DataFrame:
    """``state`` with the bin of each feature in place of its value, as bytes; -1 for NaN, which lies below every bound."""
    kind, at = _code_type(bounds), state.columns.index("_x")

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch)
            codes = np.empty(x.shape, kind)
            for f, bound in enumerate(bounds):
                codes[:, f] = np.searchsorted(bound, x[:, f], side="left")
            codes[np.isnan(x)] = -1
            yield batch.set_column(at, "_x", pa.array([c.tobytes() for c in codes], pa.binary()))

    fields = [f"{f.name} {'binary' if f.name == '_x' else f.dataType.simpleString()}" for f in state.schema]
    return state.mapInArrow(coded, ", ".join(fields))


def _codes(batch: pa.RecordBatch, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("_x").to_pylist()), kind).reshape(batch.num_rows, -1)


def _on_codes(tree: Tree, bounds: list[np.ndarray]) -> Tree:
    """The tree with the bins of its bounds: it takes a row's bins to where the tree takes its values."""
    places = [float(np.searchsorted(bounds[f], b)) if f >= 0 else 0.0 for f, b in zip(tree.feature, tree.bound, strict=True)]
    return replace(tree, bound=places)


def _moved(trees: list[Tree], bounds: list[np.ndarray]) -> Callable[[pa.RecordBatch], tuple[np.ndarray, np.ndarray]]:
    """A function from a batch to its bins and its predictions after ``trees``."""
    kind, coded = _code_type(bounds), [_on_codes(t, bounds) for t in trees]

    def predictions(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        codes = _codes(batch, kind)
        return codes, batch.column("_p").to_numpy() + sum((t.predict(codes) for t in coded), np.zeros(len(codes)))

    return predictions


def grow_level(state: DataFrame, trees: list[Tree], growing: Tree, nodes: list[int], bounds: list[np.ndarray], columns: list[int], config: BoostingConfig) -> dict:
    """``{node: (g, h, split, sums of the left side)}`` of the nodes of one level, from one scan over ``state(_x, _y, _p)``, ``_x`` being bins.

    ``_p`` is the prediction before ``trees``; the gradient of the squared error
    is the prediction minus the label, the hessian 1.
    """
    width, place = config.bins, {node: i for i, node in enumerate(nodes)}
    at = np.full(len(growing.feature), -1)
    at[nodes] = range(len(nodes))
    moved, grown, last = _moved(trees, bounds), _on_codes(growing, bounds), [len(b) for b in bounds]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((3, len(nodes), len(columns), width))
        for batch in batches:
            if not batch.num_rows:
                continue
            codes, p = moved(batch)
            slot = at[grown.nodes_of(codes)]
            here = slot >= 0
            g, base, bins = (p - batch.column("_y").to_numpy())[here], slot[here] * width, np.ascontiguousarray(codes[here].T)
            for j, f in enumerate(columns):
                cell = base + np.where(bins[f] < 0, last[f], bins[f])
                for k, w in enumerate((g, None)):
                    total[k, :, j] += np.bincount(cell, w, len(nodes) * width).reshape(len(nodes), width)
        total[2] = total[1]
        met = np.flatnonzero(total[2].sum((1, 2)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(met.astype(np.int32)), pa.array([total[:2, i].ravel() for i in met], pa.list_(pa.float64()))], names=["slot", "sums"]
        )

    def chosen(parts: pd.DataFrame) -> pd.DataFrame:
        ordered = sorted(parts["sums"].tolist(), key=lambda s: s.tobytes())  # one order of addition, whatever arrives first
        g, h = np.sum(ordered, axis=0).reshape(2, len(columns), width)
        found = best_split(g, h, h, config)
        row = (int(parts["slot"].iloc[0]), *(found or (-1, -1, 0.0, 0.0, 0.0)), float(g[0].sum()), float(h[0].sum()))
        return pd.DataFrame([row], columns=["slot", "f", "b", "gain", "gl", "hl", "g", "h"])

    parts = state.select("_x", "_y", "_p").mapInArrow(sums, "slot int, sums array<double>")
    out = {}
    for r in parts.groupBy("slot").applyInPandas(chosen, "slot int, f int, b int, gain double, gl double, hl double, g double, h double").collect():
        split = (columns[r["f"]], float(bounds[columns[r["f"]]][r["b"]]), r["gain"]) if r["f"] >= 0 else None
        out[nodes[r["slot"]]] = (r["g"], r["h"], split, (r["gl"], r["hl"]))
    return {node: out[node] for node in place if node in out}


def grow_tree(state: DataFrame, trees: list[Tree], bounds: list[np.ndarray], columns: list[int], config: BoostingConfig, rate: float) -> Tree:
    """One tree, level by level. The sums of the two sides of a split give the children's weights, so leaves need no scan."""
    tree, level = Tree(), [0]
    columns = [f for f in columns if len(bounds[f])] or columns[:1]

    def weigh(node: int, g: float, h: float) -> None:
        tree.weight[node] = rate * leaf_weight(g, h, config.l1, config.l2)

    for depth in range(max(1, config.max_depth)):
        found, below = grow_level(state, trees, tree, level, bounds, columns, config), []
        for node, (g, h, split, (gl, hl)) in found.items():
            if depth == 0:
                weigh(node, g, h)
            if split and depth < config.max_depth:
                left, right = tree.split(node, *split)
                weigh(left, gl, hl)
                weigh(right, g - gl, h - hl)
                below += [left, right]
        level = below
        if not level:
            break
    return tree


def _state(rows: DataFrame, key: str | None, label: str, features: str) -> DataFrame:
    return rows.select(_numbers(features).alias("_x"), F.col(label).cast("double").alias("_y"), *([F.col(key).cast("string").alias("_key")] if key else [])).where("_x IS NOT NULL AND _y IS NOT NULL")


@dataclass
class StoredRows:
    """Rows stored for fits; none without training rows."""

    spark: SparkSession
    rows: H.Rows | None


def boosting_rows(train: DataFrame, val: DataFrame | None = None, key: str = "trip_key", features: str = "features", label: str = "label", bins: int = 64) -> StoredRows:
    """Rows stored for boosting fits; several fits can share them.

    ``key`` names the rows for the sampling of a round; where it is missing, features and label do. Rows without features
    or label are left out.
    """

    def some(rows: DataFrame, held: bool) -> DataFrame:
        names = [F.col(key).cast("string")] if key in rows.columns else [_numbers(features), F.col(label).cast("double")]
        known = rows.select(_numbers(features).alias("_x"), F.col(label).cast("double").alias("_y"), F.xxhash64(*names).alias("_hash"))
        return known.where("_x IS NOT NULL AND _y IS NOT NULL").withColumn("_val", F.lit(held))

    return StoredRows(train.sparkSession, H.prepare(some(train, False) if val is None else some(train, False).union(some(val, True)), bins))


def fit_rounds(stored: StoredRows, config: BoostingConfig, tasks: int | None = None, cut: bool = True) -> Boosted:
    """Trees on stored rows in at most ``tasks`` tasks; with ``cut`` those up to the best round on the validation rows."""
    if stored.rows is None:
        return Boosted(0.0, [], [], 0)
    trees, losses = H.fit(stored.spark, stored.rows, config, tasks)
    best = min(range(len(losses)), key=lambda i: losses[i][1], default=-1) + 1 if cut else len(trees)
    return Boosted(stored.rows.start, trees[:best], losses, best, stored.rows.size, trees)


def fit_boosting(train: DataFrame, val: DataFrame, config: BoostingConfig | None = None, key: str = "trip_key", features: str = "features", label: str = "label") -> Boosted:
    """Boosted trees on the squared error, cut at the best round on the validation rows.

    ``key`` names the rows for the sampling of a round. Rows without features or
    label are left out; without training rows the model is 0. The fit ends once
    ``patience`` rounds brought nothing better; no second fit is needed.
    """
    config = config or BoostingConfig()
    return fit_rounds(boosting_rows(train, val, key, features, label, config.bins), config)


def fit_regression_tree(train: DataFrame, max_depth: int = 5, min_split: int = 2, min_leaf: int = 1, bins: int = 64, features: str = "features", label: str = "label") -> Boosted:
    """A least-squares tree that splits only nodes of at least ``min_split`` rows into children of at least ``min_leaf``."""
    rows = _state(train, None, label, features)
    size = rows.agg(F.max(F.size("_x"))).first()[0]
    if size is None:
        return Boosted(0.0, [], [], 0)
    config = BoostingConfig(max_depth=max_depth, l2=0.0, min_weight=0.0, min_split=min_split, min_leaf=min_leaf, bins=bins)
    bounds = bin_bounds(rows, size, bins)
    state = materialize(binned(rows, bounds), "tree-rows", row_group=ROW_GROUP).withColumn("_p", F.lit(0.0))
    tree = grow_tree(state, [], bounds, list(range(size)), config, 1.0)
    return Boosted(0.0, [tree], [], 1)
