from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabforge.operators import boosting as G

COLUMNS = ["a", "b", "c"]


def table(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 2, n), np.round(rng.normal(size=n), 1)]).astype(float)
    y = 10 + x[:, 0] * (1 - x[:, 1]) + 2 * (x[:, 2] > 0) + 0.3 * rng.normal(size=n)
    rows = [(i, *map(float, v), float(t)) for i, (v, t) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double").repartition(5)
    return VectorAssembler(inputCols=COLUMNS, outputCol="features").transform(df), x, y


def plain_tree(x, g, h, config, depth=0, rate=1.0):
    """Greedy splits over all places between different values, as nested tuples or a leaf weight."""

    def quality(g, h):
        return max(abs(g) - config.l1, 0) ** 2 / (h + config.l2)

    weight = rate * G.leaf_weight(g.sum(), h.sum(), config.l1, config.l2)
    if depth == config.max_depth or len(g) < config.min_split:
        return weight
    best = (1e-9, None)
    for f in range(x.shape[1]):
        for bound in np.unique(x[:, f])[:-1]:
            low = x[:, f] <= bound
            if min(low.sum(), (~low).sum()) < config.min_leaf or min(h[low].sum(), h[~low].sum()) < config.min_weight:
                continue
            gain = (quality(g[low].sum(), h[low].sum()) + quality(g[~low].sum(), h[~low].sum()) - quality(g.sum(), h.sum())) / 2
            if gain > best[0] * (1 + 1e-9):
                best = (gain, (f, bound))
    if best[1] is None:
        return weight
    f, bound = best[1]
    low = x[:, f] <= bound
    return (f, bound, *(plain_tree(x[s], g[s], h[s], config, depth + 1, rate) for s in (low, ~low)))


def plain_predict(tree, x):
    return np.array([_leaf(tree, row) for row in x])


def _leaf(tree, row):
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


@pytest.mark.parametrize(("min_split", "min_leaf", "depth"), [(2, 1, 3), (40, 1, 4), (2, 25, 4), (90, 10, 2)])
def test_tree_equals_plain_cart(spark, min_split, min_leaf, depth):
    df, x, y = table(spark, 200, 1)
    model = G.fit_regression_tree(df, depth, min_split, min_leaf, bins=256)
    config = G.BoostingConfig(max_depth=depth, l2=0.0, min_weight=0.0, min_split=min_split, min_leaf=min_leaf)
    expected = plain_predict(plain_tree(x, -y, np.ones(len(y)), config), x)
    assert model.predict(x) == pytest.approx(expected, abs=1e-9)
    scored = {r["id"]: r["prediction"] for r in model.transform(df).collect()}
    assert [scored[i] for i in range(200)] == pytest.approx(expected.tolist(), abs=1e-9)
    shallow = G.fit_regression_tree(df, depth - 1, min_split, min_leaf, bins=256)
    assert model.trees[0].cut(depth - 1).predict(x) == pytest.approx(shallow.predict(x), abs=1e-9)


def test_minimum_split_size_changes_the_tree(spark):
    df, x, _ = table(spark, 200, 1)
    sizes = [len(set(G.fit_regression_tree(df, 5, m, 1, bins=256).predict(x))) for m in (2, 60)]
    assert sizes[1] < sizes[0]


@pytest.mark.parametrize(("l1", "l2", "min_weight"), [(0.0, 1.0, 1.0), (5.0, 3.0, 1.0), (0.0, 0.0, 30.0)])
def test_boosting_equals_plain_rounds(spark, l1, l2, min_weight):
    df, x, y = table(spark, 200, 2)
    config = G.BoostingConfig(rounds=3, rate=0.5, max_depth=2, rows=1.0, columns=1.0, l1=l1, l2=l2, min_weight=min_weight, bins=256, store_every=2)
    model = G.fit_boosting(df, df, config, "id")
    p = np.full(len(y), y.mean())
    losses = []
    for _ in range(3):
        p = p + plain_predict(plain_tree(x, p - y, np.ones(len(y)), config, rate=config.rate), x)
        losses.append(float(np.mean((p - y) ** 2)))
    assert [t for t, _ in model.losses] == pytest.approx(losses, rel=1e-9)
    assert model.predict(x) == pytest.approx(p, abs=1e-9)


def test_training_loss_falls_and_patience_stops_without_a_second_fit(spark):
    df, x, y = table(spark, 300, 3)
    noise = df.withColumn("label", F.lit(12.0) + F.pmod(F.xxhash64("id"), F.lit(1000)) / 100)
    train, val = noise.where("id % 3 > 0"), noise.where("id % 3 = 0")
    config = G.BoostingConfig(rounds=40, rate=0.4, max_depth=2, rows=1.0, columns=1.0, patience=3)
    model = G.fit_boosting(train, val, config, "id")
    losses = [t for t, _ in model.losses]
    assert all(b <= a + 1e-12 for a, b in zip(losses, losses[1:], strict=False))
    held = [v for _, v in model.losses]
    assert len(held) < 40 and model.best_iteration == held.index(min(held)) + 1 == len(held) - 3
    assert len(model.trees) == model.best_iteration
    scored = model.transform(val).agg(F.avg(F.pow(F.col("prediction") - F.col("label"), 2))).first()[0]
    assert scored == pytest.approx(min(held), rel=1e-9)


def test_shares_of_rows_and_columns_are_repeatable(spark):
    df, x, _ = table(spark, 200, 4)
    config = G.BoostingConfig(rounds=3, rate=0.5, max_depth=2, rows=0.6, columns=0.7)
    one, two = (G.fit_boosting(df.repartition(n), df, config, "id") for n in (2, 7))
    assert one.predict(x) == pytest.approx(two.predict(x), abs=1e-9)
    full = G.fit_boosting(df, df, G.BoostingConfig(rounds=3, rate=0.5, max_depth=2, rows=1.0, columns=1.0), "id")
    assert not np.allclose(one.predict(x), full.predict(x))
    assert full.importances(3).sum() == pytest.approx(1.0) and full.importances(3)[0] > 0.3


def test_missing_rows_constant_features_and_empty_tables(spark):
    df, _, _ = table(spark, 30, 5)
    same = df.withColumn("label", F.lit(2.0))
    model = G.fit_boosting(same, same.where("false"), G.BoostingConfig(rounds=2), "id")
    assert {r["prediction"] for r in model.transform(same).collect()} == {2.0}
    odd = df.select("id", F.when(F.col("id") > 3, F.col("features")).alias("features"), F.when(F.col("id") > 5, F.col("label")).alias("label"))
    found = G.fit_boosting(odd, odd, G.BoostingConfig(rounds=1), "id").transform(odd).collect()
    assert sum(r["prediction"] is None for r in found) == 4 and len(found) == 30
    empty = G.fit_boosting(df.where("false"), df, G.BoostingConfig(rounds=2), "id")
    assert (empty.start, empty.trees) == (0.0, []) and G.fit_regression_tree(df.where("false")).trees == []
    assert math.isclose(G.leaf_weight(5.0, 2.0, 1.0, 2.0), -1.0) and G.leaf_weight(0.5, 2.0, 1.0, 2.0) == 0.0


def test_rows_are_kept_as_bins_that_lead_to_the_same_leaves(spark):
    df, x, _ = table(spark, 200, 6)
    gap = df.select("id", F.when(F.col("id") % 9 == 0, F.array(F.lit(float("nan")), "b", "c")).otherwise(F.array("a", "b", "c")).alias("_x"))
    bounds = [np.unique(x[:, f])[:-1] for f in range(3)]
    tree = G.Tree()
    left, right = tree.split(0, 0, float(bounds[0][3]), 1.0)
    tree.split(right, 2, float(bounds[2][5]), 1.0)
    for many in (bounds, [*bounds[:2], np.linspace(-9, 9, 200)]):
        rows = G.binned(gap, many).collect()
        width = np.dtype(G._code_type(many)).itemsize
        assert len(rows) == 200 and {len(r["_x"]) for r in rows} == {3 * width}
        codes = np.array([np.frombuffer(r["_x"], G._code_type(many)) for r in rows])
        values = np.array([[np.nan if r["id"] % 9 == 0 else x[r["id"], 0], *x[r["id"], 1:]] for r in rows])
        single = G.Tree()
        single.split(0, 0, float(many[0][3]), 1.0)
        grown = tree if many is bounds else single
        assert (G._on_codes(grown, many).nodes_of(codes) == grown.nodes_of(values)).all()
        assert (codes[:, 0] == -1).sum() == 23


def test_indicators_share_a_column_and_lead_to_the_same_trees(spark, monkeypatch):
    monkeypatch.setattr(G.H, "CELLS", (4096, 4096))
    rng = np.random.default_rng(7)
    n = 400
    brand, x = rng.integers(0, 6, n), np.round(rng.normal(size=n), 1)
    y = 3.0 * (brand == 2) - 2.0 * (brand == 5) + x * (brand == 1) + 0.1 * rng.normal(size=n)
    rows = [(i, *[float(b == k) for k in range(6)], float(v), float(t)) for i, (b, v, t) in enumerate(zip(brand, x, y, strict=True))]
    names = [*[f"b{k}" for k in range(6)], "x"]
    df = VectorAssembler(inputCols=names, outputCol="features").transform(spark.createDataFrame(rows, ["id", *names, "label"]).repartition(3))
    stored = G.boosting_rows(df, key="id", bins=256)
    assert stored.rows.lay.columns == [[0, 1, 2, 3, 4, 5], [6]] and len(stored.rows.lay.groups) == 1
    values = np.array([r[1:-1] for r in rows])
    config = G.BoostingConfig(rounds=4, rate=0.5, max_depth=3, rows=1.0, columns=1.0, bins=256)
    p = np.full(n, y.mean())
    for _ in range(4):
        p = p + plain_predict(plain_tree(values, p - y, np.ones(n), config, rate=config.rate), values)
    assert G.fit_rounds(stored, config).predict(values) == pytest.approx(p, abs=1e-9)


def test_one_task_and_several_grow_the_same_trees(spark, monkeypatch):
    df, x, _ = table(spark, 300, 8)
    stored = G.boosting_rows(df, df, "id")
    config = G.BoostingConfig(rounds=5, rate=0.3, max_depth=4, rows=0.7, columns=0.7)
    assert len(stored.rows.blocks) == 10
    one, some = (G.fit_rounds(stored, config, tasks) for tasks in (1, 3))
    monkeypatch.setattr(G.H, "TOGETHER", 0)
    monkeypatch.setattr(G.H, "KEPT_ROWS", 10)
    apart, _ = G.H._work(stored.rows, config, G.H._Team("", 0, 1))
    assert one.grown == some.grown == apart and np.ravel(one.losses) == pytest.approx(np.ravel(some.losses), rel=1e-12)


def test_a_scorer_takes_rows_to_the_leaves_of_deep_trees():
    rng = np.random.default_rng(9)
    tree, level = G.Tree(), [0]
    for _ in range(8):
        level = [c for node in level if rng.random() < 0.9 for c in tree.split(node, int(rng.integers(0, 3)), float(rng.integers(0, 9)), 1.0)]
    tree.weight = rng.normal(size=len(tree.weight)).tolist()
    x = rng.integers(-1, 11, (5000, 3)).astype(float)
    x[::50, 1] = np.nan
    assert sum(f < 0 for f in tree.feature) > 64
    assert G._Scorer([tree, tree.cut(3)])(x) == pytest.approx(tree.predict(x) + tree.cut(3).predict(x), abs=1e-12)
    assert G._Scorer([G.Tree()])(x).tolist() == [0.0] * 5000


def test_a_bagged_forest_averages_trees_on_repeated_rows(spark):
    df, x, y = table(spark, 400, 10)
    forest = G.fit_rounds(G.boosting_rows(df, key="id"), G.BoostingConfig(30, 1 / 30, 5, 1.0, 1.0, 0.0, 0.0, 0.0, bagged=True, node_columns=0.7), cut=False)
    assert len(forest.trees) == 30 and len({tuple(t.bound) for t in forest.trees}) > 20
    assert 1 - np.var(y - forest.predict(x)) / np.var(y) > 0.9
    grown = [30 * t.predict(x) + forest.start for t in forest.trees]
    assert forest.predict(x) == pytest.approx(np.mean(grown, 0)) and min(map(np.min, grown)) >= y.min() - 1e-9
