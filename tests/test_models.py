from __future__ import annotations

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from tabforge.operators import evaluation as E
from tabforge.operators import interpretation as I
from tabforge.operators import lookups as L
from tabforge.operators import models as M
from tabforge.operators import tuning as U


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(0)
    n = 600
    a, b, c = rng.normal(size=(3, n))
    y = 3 * a + 2 * b + 0.1 * rng.normal(size=n) + 10
    rows = [(i, *map(float, v)) for i, v in enumerate(zip(a, b, c, y, strict=True))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, label double")
    df = df.withColumns(
        {
            "split": F.when(F.col("id") < 420, "train").when(F.col("id") < 510, "val").otherwise("test"),
            "fold": (F.col("id") % 3).cast("int"),
            "share_bucket": (F.col("id") * 37 % 1000).cast("int"),
        }
    )
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


@pytest.fixture(scope="module")
def train(data):
    return data.where("split = 'train'")


@pytest.fixture(scope="module")
def val(data):
    return data.where("split = 'val'")


def _xy(frame):
    p = frame.select("a", "b", "c", "label").toPandas()
    return p[["a", "b", "c"]].to_numpy(), p["label"].to_numpy()


def test_linear(train, data):
    model = M.fit_linear(train)
    x, y = _xy(train)
    want = np.linalg.lstsq(np.c_[x, np.ones(len(x))], y, rcond=None)[0]
    assert model.coefficients.toArray() == pytest.approx(want[:3], rel=1e-8)
    metrics = {r["split"]: r for r in E.metrics_by_split(M.predict_splits(model, data, "linear")).collect()}
    assert metrics["train"]["r2"] > 0.95 and metrics["test"]["r2"] > 0.95
    assert M.fit_linear(train).coefficients == model.coefficients


@pytest.mark.parametrize("alpha", [0.1, 10.0, 300.0])
def test_ridge_scale(train, alpha):
    x, y = _xy(train)
    xc, yc = x - x.mean(0), y - y.mean()
    want = np.linalg.solve(xc.T @ xc + alpha * np.eye(3), xc.T @ yc)
    assert M.fit_ridge(train, alpha).coefficients.toArray() == pytest.approx(want, rel=1e-6)


def test_lasso_zeroes_the_noise_feature(spark, train):
    model = M.fit_lasso(train, 0.5)
    x, y = _xy(train)
    xc, yc = x - x.mean(0), y - y.mean()
    w = np.zeros(3)
    for _ in range(500):
        for j in range(3):
            r = yc - xc @ w + xc[:, j] * w[j]
            rho = xc[:, j] @ r / len(y)
            w[j] = np.sign(rho) * max(abs(rho) - 0.5, 0) / (xc[:, j] @ xc[:, j] / len(y))
    assert model.coefficients.toArray() == pytest.approx(w, abs=1e-5)
    row = I.zeroed(I.importance(spark, "lasso", model, ["a", "b", "c"])).first()
    assert row["zeroed"] == 1 and row["zeroed_pct"] == 33.33


def test_trees_importances_and_agreement(spark, train):
    models = {"tree": M.fit_tree(train, 5), "forest": M.fit_forest(train, 10, 6), "gbt": M.fit_gbt(train, 5, 0.3, 3), "gone": None}
    with pytest.warns(UserWarning, match="gone"):
        table = I.importance_all(spark, models, ["a", "b", "c"])
    sums = [r["s"] for r in table.groupBy("model").agg(F.sum("importance").alias("s")).collect()]
    assert sums == pytest.approx([1.0] * 3)
    assert {r["feature"] for r in I.agreement(table, ["tree", "forest", "gbt"], 2).collect()} == {"a", "b"}
    assert I.side_by_side(table, "tree", "gbt", 2).count() == 2
    assert [r["rank"] for r in I.top_features(table, 1).collect()] == [1, 1, 1]


def test_unlimited_depth():
    assert M._depth(None) == 30 and M._depth(15) == 15
    with pytest.raises(ValueError, match="depth"):
        M._depth(31)


def test_patience_bridges_a_dip():
    losses = [9.0, 7.0, 8.0, 8.5, 6.0, 6.5, 6.4, 6.3, 5.0]
    assert M.best_iteration(losses, 3) == 5
    assert M.best_iteration(losses, 2) == 2
    assert M.best_iteration(losses, 50) == 9


def test_early_stop_ends_at_its_best_iteration(train, val):
    stopped = M.fit_gbt_early_stop(train, val, trees=12, rate=0.5, max_depth=3)
    assert stopped.best_iteration == stopped.model.getNumTrees <= 12
    assert stopped.val_rmse > 0


def test_stacking_beats_its_weakest_base(train, val):
    bases = {"tree": lambda t: M.fit_tree(t, 2), "forest": lambda t: M.fit_forest(t, 5, 5)}
    stacked = M.fit_stacking(train, bases, 3)
    assert set(stacked.weights) == {"tree", "forest"}

    def r2(model):
        return E.regression_metrics(model.transform(val)).first()["r2"]

    assert r2(stacked) > r2(stacked.bases["tree"])


def test_stacking_decodes_its_rows_once_and_keeps_none(spark, train, tmp_path):
    path, seen = str(tmp_path / "rows"), []
    train.select("features", "label", "fold").write.parquet(path)
    rows = spark.read.parquet(path)
    bases = {"tree": lambda t: seen.append("InMemoryTableScan" in t._jdf.queryExecution().executedPlan().toString()) or M.fit_tree(t, 2)}
    stacked = M.fit_stacking(rows, bases, 3)
    assert seen == [True] * 4 and not rows.storageLevel.useDisk
    alone = M.fit_tree(rows, 2)
    assert stacked.bases["tree"].toDebugString.split("\n")[1:] == alone.toDebugString.split("\n")[1:]


def test_kept_rows_leave_a_persisted_table_alone(train):
    mine = train.select("features", "label").persist()
    with M.kept_rows(mine) as rows:
        assert rows is mine
    assert mine.storageLevel.useMemory
    mine.unpersist()


def test_searches(train):
    ridge = U.cross_validate(train, M.fit_ridge, [{"alpha": 0.1}, {"alpha": 5000.0}], 3)
    assert ridge.params == {"alpha": 0.1}
    tree = U.grid_search(train, DecisionTreeRegressor(seed=1), U.grid({"maxDepth": [1, 5]}), 3)
    assert tree.params == {"maxDepth": 5} and len(tree.table) == 2
    assert tree.frame(train).where("rank = 1").count() == 1
    assert U.draws({"x": [1, 2], "y": [3]}, 5) == [{"x": 1, "y": 3}, {"x": 2, "y": 3}]
    assert U.boosting_draws(3) == U.boosting_draws(3)


def test_tuning_and_curves(data, train, val):
    found = U.tune_random(train, val, [{"trees": 2, "rate": 0.1, "max_depth": 2}, {"trees": 8, "rate": 0.5, "max_depth": 3}])
    assert found.params["trees"] == 8
    path = U.regularization_path(data, [0.01, 1000.0])
    best = {(r["model"], r["alpha"], r["split"]): r["r2"] for r in path.collect()}
    assert len(best) == 8 and best["ridge", 0.01, "val"] > best["lasso", 1000.0, "val"]
    curve = U.learning_curve(train, M.fit_linear, [0.2, 1.0], 3).collect()
    assert curve[0]["rows"] < curve[1]["rows"] and curve[1]["val_r2_mean"] > 0.95


def test_metrics_edge_cases(spark):
    def of(rows):
        return E.regression_metrics(spark.createDataFrame(rows, "label double, prediction double")).first()

    assert tuple(of([(1.0, 1.0), (2.0, 2.0)])) == (1.0, 0.0, 0.0, 0.0)
    known = of([(100.0, 110.0), (200.0, 190.0)])
    assert (known["mae"], known["rmse"], known["mape"]) == (10.0, 10.0, 7.5)
    assert of([(0.0, 1.0), (2.0, 2.0)])["mape"] == 0.0
    assert of([(0.0, 1.0), (0.0, 2.0)])["mape"] is None
    assert of([(1.0, 3.0), (2.0, 0.0)])["r2"] < 0
    assert of([(5.0, 5.0), (5.0, 5.0)])["r2"] == 1.0 and of([(5.0, 4.0), (5.0, 5.0)])["r2"] == 0.0
    assert of([(5.0, 4.0)])["r2"] is None
    assert of([])["mae"] is None


def test_diagnosis_leaderboard_and_champion(spark):
    rows = [(m, s, r, 0.0, 0.0, 0.0) for m, s, r in (("a", "train", 0.99), ("a", "val", 0.8), ("b", "train", 0.4), ("b", "val", 0.4), ("c", "train", 0.9), ("c", "val", 0.9))]
    metrics = spark.createDataFrame(rows, "model string, split string, r2 double, mae double, rmse double, mape double")
    assert {r["model"]: r["diagnosis"] for r in E.fit_diagnosis(metrics).collect()} == {"a": "overfit", "b": "underfit", "c": "ok"}
    ranks = {(r["model"], r["split"]): r["rank"] for r in L.leaderboard(metrics).collect()}
    assert (ranks["c", "val"], ranks["a", "val"], ranks["a", "train"]) == (1, 2, 1)
    runs = E.run_log(metrics, F.create_map(F.lit("k"), F.lit("v")), F.lit("t"))
    assert L.champion(runs, "val_r2").first()["model"] == "c"


def test_alias_timeline_before_and_after_a_new_champion(spark):
    rows = [(m, s, r, 0.0, 0.0, 0.0) for m, s, r in (("a", "val", 0.8), ("b", "val", 0.9), ("a", "test", 0.7), ("b", "test", 0.6))]
    metrics = spark.createDataFrame(rows, "model string, split string, r2 double, mae double, rmse double, mape double")
    runs = E.run_log(metrics, F.create_map(F.lit("k"), F.lit("v")), F.lit("t"))
    events = L.champion_event(runs, "val_r2", "champion", F.lit(1)).union(L.champion_event(runs, "test_r2", "champion", F.lit(5)))
    more = [("b", "champion", 9), ("b", "champion", 9), ("a", "shadow", 5), (None, "shadow", 7), ("a", "tied", 6), ("c", "tied", 6)]
    timeline = L.alias_timeline(events.union(spark.createDataFrame(more, "model string, alias string, at int")))

    def at(t):
        return {r["alias"]: (r["model"], r["version"]) for r in L.alias_holders(timeline, F.lit(t)).collect()}

    assert at(0) == {}
    assert at(1) == at(4) == {"champion": ("b", 1)}
    assert at(5) == {"champion": ("a", 1), "shadow": ("a", 2)}
    assert at(8) == {"champion": ("a", 1), "tied": ("c", 1)}
    assert at(9) == {"champion": ("b", 2), "tied": ("c", 1)}
    assert L.alias_timeline(spark.createDataFrame([], "model string, alias string, at int")).count() == 0


def test_fits_of_a_large_search_run_one_after_the_other(train, monkeypatch):
    running, most = [], []

    class Estimator:
        def getParam(self, name):
            return name

        def fit(self, rows, params):
            running.append(1)
            most.append(len(running))
            model = DecisionTreeRegressor(maxDepth=params["maxDepth"]).fit(rows)
            running.pop()
            return model

    monkeypatch.setattr(U, "SIDE_BY_SIDE", 10)
    found = U.grid_search(train, Estimator(), U.grid({"maxDepth": [1, 3]}), 3)
    assert max(most) == 1 and len(most) == 7 and found.params == {"maxDepth": 3}
    with pytest.raises(ValueError, match="no rows"):
        U.grid_search(train, DecisionTreeRegressor(), [{"maxDepth": 1}], 4)


def test_tree_fits_read_small_tasks(spark, train):
    class Estimator:
        def fit(self, rows, params):
            return rows.sparkSession.conf.get("spark.sql.files.maxPartitionBytes")

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    assert M.fit_trees(Estimator(), train) == str(M.TASK_BYTES) != before
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") == before


def test_tuning_fits_a_candidate_once(train, val, monkeypatch):
    fits, real = [], M.fit_gbt
    monkeypatch.setattr(M, "fit_gbt", lambda t, trees=300, *a, **k: fits.append(trees) or real(t, trees, *a, **k))
    found = U.tune_random(train, val, [{"trees": 2, "rate": 0.1, "max_depth": 2}, {"trees": 5, "rate": 0.3, "max_depth": 2}])
    assert fits == [2, 5] and found.model.getNumTrees == 5


def test_only_named_models_are_fitted(spark, monkeypatch):
    from types import SimpleNamespace

    from pyspark.ml.linalg import Vectors

    from tabforge.plans import model_queries as Q

    fitted = []
    monkeypatch.setattr(Q, "_fit", lambda s, d, name: fitted.append(name) or SimpleNamespace(coefficients=Vectors.dense(2.0, 1.0)))
    monkeypatch.setattr(Q, "training_table", lambda s, d: (None, SimpleNamespace(feature_names=["a", "b"])))
    two = Q.queries()["importance_side_by_side"](spark, "").collect()
    assert [(r["linear_feature"], r["lasso_feature"]) for r in two] == [("a", "a"), ("b", "b")] and fitted == ["linear", "lasso"]
    fitted.clear()
    assert Q.queries()["importance_agreement"](spark, "").count() == 2 and fitted == ["linear", "forest", "gbt"]


def test_registered_boosting_has_its_whole_settings():
    from tabforge.plans import model_queries as Q

    assert Q.BOOST == {"trees": 300, "rate": 0.05, "max_depth": 6}
    early = Q.EARLY
    assert (early.rounds, early.rate, early.max_depth, early.rows, early.columns, early.patience) == (500, 0.03, 7, 0.8, 0.8, 50)
    assert (Q.TRIALS, Q.TRIAL_TREES) == (100, (200, 800))
    draw = U.boosting_draws(Q.TRIALS, Q.TRIAL_TREES)
    assert len(draw) == 100 and {"l1", "l2"} < draw[0].keys() and {p["max_depth"] for p in draw} == set(range(3, 10))


def test_stacking_has_its_three_ensembles(spark, monkeypatch):
    from tabforge.plans import model_queries as Q

    seen = {}
    monkeypatch.setattr(Q, "split", lambda s, d, name: spark.createDataFrame([(0,)], "stack_fold int"))
    monkeypatch.setattr(Q, "_metrics", lambda s, d, name, model: None)
    monkeypatch.setattr(M, "fit_stacking", lambda rows, bases, folds: seen.update(bases, folds=folds))
    Q.queries()["fit_stacking"](spark, "")
    fits = []
    monkeypatch.setattr(M, "fit_gbt", lambda t, **k: fits.append(k))
    monkeypatch.setattr(M, "fit_bagged", lambda t, **k: fits.append(k))
    for name in ("forest", "gbt", "boosting"):
        seen[name](None)
    assert seen["folds"] == 3 and [k["trees"] for k in fits] == [200, 200, 300]
    assert fits[0]["features"] == "0.7" and fits[0]["max_depth"] == 8 and fits[2]["l2"] == 1.0 and fits[2]["features"] == "0.8"


def test_a_stopped_best_trial_is_refit_with_all_rounds(train, val):
    noisy = train.withColumn("label", F.col("label") + F.pmod(F.xxhash64("id"), F.lit(100)))
    found = U.tune_random(noisy, val, [{"trees": 40, "rate": 0.9, "max_depth": 4}], patience=2)
    assert found.model.getNumTrees == 40
    assert M.fit_gbt_early_stop(noisy, val, 40, 0.9, 4, patience=2).full is None
