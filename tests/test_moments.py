from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from tabforge.operators import models as M
from tabforge.operators import moments as S
from tabforge.operators import tuning as U


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(600, 4)) * (1, 2, 0.5, 1)
    y = 50 + x @ (3.0, -2.0, 0.0, 1.0) + rng.normal(size=600)
    data = [(*map(float, a), float(b), i % 5, (i * 37) % 1000, "val" if i % 6 == 0 else "train") for i, (a, b) in enumerate(zip(x, y, strict=True))]
    df = spark.createDataFrame(data, "a double, b double, c double, d double, label double, fold int, share_bucket int, split string")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df).repartition(6)


def plain(df):
    table = np.array([[*r["features"].toArray(), r["label"]] for r in df.select("features", "label").collect()])
    return table[:, :-1], table[:, -1]


def ridge(x, y, alpha):
    mx, my = x.mean(0), y.mean()
    w = np.linalg.solve((x - mx).T @ (x - mx) + alpha * np.eye(x.shape[1]), (x - mx).T @ (y - my))
    return my - mx @ w, w


@pytest.mark.parametrize("alpha", [0.0, 1.0, 100.0])
def test_sums_of_folds_give_separate_fits(rows, alpha):
    cells = S.product_sums(rows, ["fold"])
    for k in range(5):
        x, y = plain(rows.where(F.col("fold") != k))
        b, w = ridge(x, y, alpha)
        line = S.solve_ridge(S.total(cells, lambda f, k=k: f != k), alpha)
        assert line.intercept == pytest.approx(b, abs=1e-8) and line.coefficients == pytest.approx(w, abs=1e-8)
        hx, hy = plain(rows.where(F.col("fold") == k))
        assert S.rmse(cells[k,], line) == pytest.approx(math.sqrt(np.mean((hy - b - hx @ w) ** 2)), abs=1e-8)


@pytest.mark.parametrize("alpha", [0.01, 0.5, 3.0, 100.0])
def test_lasso_equals_the_spark_fit(rows, alpha):
    line = S.solve_lasso(S.product_sums(rows, [])[()], alpha)
    model = M.fit_lasso(rows, alpha)
    assert line.coefficients == pytest.approx(model.coefficients.toArray(), abs=1e-5)
    assert line.intercept == pytest.approx(model.intercept, abs=1e-5)
    x, y = plain(rows)
    r = y - line.intercept - x @ line.coefficients
    pull = np.abs(x.T @ r / len(y))  # the optimality conditions of the lasso
    assert (pull <= alpha + 1e-7).all() and pull[line.coefficients != 0] == pytest.approx(alpha, abs=1e-7)


def test_search_path_and_curve_equal_the_ways_that_fit_again(rows):
    search = U.search_linear(rows, "ridge", [0.1, 10.0, 1000.0])
    again = U.cross_validate(rows, M.fit_ridge, [{"alpha": a} for a in (0.1, 10.0, 1000.0)], 5)
    assert search.params == again.params
    assert dict((p["alpha"], v) for p, v in search.table) == pytest.approx(dict((p["alpha"], v) for p, v in again.table), abs=1e-6)
    shares = [0.3, 1.0]
    curve = U.linear_learning_curve(rows, "ridge", 1.0, shares).collect()
    slow = U.learning_curve(rows, lambda t: M.fit_ridge(t, 1.0), shares, 5).collect()
    for a, b in zip(curve, slow, strict=True):
        assert list(a) == pytest.approx(list(b), abs=1e-6)
    path = {(r["model"], r["alpha"], r["split"]): r["r2"] for r in U.regularization_path(rows, [1.0, 50.0]).collect()}
    assert len(path) == 8 and path["ridge", 1.0, "train"] > path["ridge", 50.0, "train"] > 0.8


def test_missing_values_collinear_features_and_empty_tables(spark):
    df = spark.createDataFrame([(1.0, 2.0, 3.0), (2.0, 4.0, 5.0), (3.0, 6.0, 7.0), (None, 1.0, 1.0), (1.0, float("nan"), 1.0), (1.0, 1.0, None)], "a double, b double, label double")
    sums = S.product_sums(df, [], ["a", "b"])[()]
    line = S.solve_linear(sums)
    assert sums[0, 0] == 3 and S.r2(sums, line) == pytest.approx(1.0) and line.intercept == pytest.approx(1.0)
    assert S.r2(S.product_sums(df.limit(1), [], ["a"])[()], line._replace(coefficients=np.zeros(1))) is None
    assert S.product_sums(df.where("false"), ["a"], ["b"]) == {}
    assert S.cross_validated({}, "ridge", [1.0]) == []
