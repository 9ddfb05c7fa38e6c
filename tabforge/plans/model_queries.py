"""Queries and oracles: model fitting, evaluation, interpretation and scoring."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, RandomForestRegressor
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.hashing import bucket
from tabforge.functions.numeric import half_even
from tabforge.operators import boosting as G
from tabforge.operators import evaluation as E
from tabforge.operators import features as X
from tabforge.operators import interpretation as I
from tabforge.operators import lookups as L
from tabforge.operators import models as M
from tabforge.operators import moments as S
from tabforge.operators import scoring as V
from tabforge.operators import tuning as U
from tabforge.plans import feature_queries as FQ
from tabforge.plans import trips as B
from tabforge.plans.model_data import FOLDS, STACK_FOLDS, labelled, scored_sql, simple_predictions, split, training_table
from tabforge.session import materialize, scratch_path
from tabforge.sources import tables as IO
from tabforge.streaming.scoring import file_stream, start_scoring

# Small settings for the registered single trees and forests; the operators default to the full ones, which boosting has.
TREE = {"max_depth": 6, "min_leaf": 4}
FOREST = {"trees": 12, "max_depth": 7, "min_leaf": 4, "features": "0.7"}
BOOST = {"trees": 300, "rate": 0.05, "max_depth": 6}
EARLY = G.BoostingConfig(rounds=500, rate=0.03, max_depth=7, rows=0.8, columns=0.8, patience=50)
STACK = {
    "forest": {"trees": 200, "max_depth": 8, "min_leaf": 4, "features": "0.7"},
    "gbt": {"trees": 200, "rate": 0.05, "max_depth": 5},
    "boosting": {"trees": 300, "rate": 0.05, "max_depth": 6, "features": "0.8", "l2": 1.0},
}
TRIALS, TRIAL_TREES = 100, (200, 800)
STUMP = G.BoostingConfig(rounds=1, rate=0.3, max_depth=1, rows=1.0, columns=1.0, bins=256)
RIDGE_ALPHAS = [0.1, 1.0, 10.0, 100.0]
LASSO_ALPHAS = [0.01, 0.1, 1.0, 10.0]
SHARES = [0.1, 0.2, 0.4, 0.6, 0.8, 1.0]
PATH_ALPHAS = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0, 1_000.0, 10_000.0]
ONE_ALPHA = {"ridge": 1000.0, "lasso": 500.0}

_fitted: dict[tuple, object] = {}


def _fit(spark, d, name):
    """A model of the comparison, fitted once per session and data folder."""
    key = (spark.sparkContext.applicationId, d, name)
    if key not in _fitted:
        train = split(spark, d, "train")
        fits = {
            "linear": lambda: M.fit_linear(train),
            "ridge": lambda: M.fit_ridge(train, 10.0),
            "lasso": lambda: M.fit_lasso(train, 50.0),
            "tree": lambda: M.fit_tree(train, **TREE),
            "forest": lambda: M.fit_forest(train, **FOREST),
            "gbt": lambda: M.fit_gbt(train, **BOOST),
        }
        _fitted[key] = fits[name]()
    return _fitted[key]


def _metrics(spark, d, name, model):
    return E.metrics_by_split(M.predict_splits(model, training_table(spark, d)[0], name), ["model"])


def _fit_metrics(name):
    return lambda spark, d: _metrics(spark, d, name, _fit(spark, d, name))


def _one_feature(spark, d):
    """Training rows with the single feature ``duration``."""
    rows = labelled(spark, d).where("split = 'train'").select("duration", F.col("fare_signal").alias("label"))
    return materialize(VectorAssembler(inputCols=["duration"], outputCol="features").transform(rows), "one-feature")


def _line(name):
    def run(spark, d):
        train = _one_feature(spark, d)
        model = {
            "fit_linear": lambda: M.fit_linear(train),
            "fit_ridge": lambda: M.fit_ridge(train, ONE_ALPHA["ridge"]),
            "fit_lasso": lambda: M.fit_lasso(train, ONE_ALPHA["lasso"]),
        }[name]()
        rows = [(float(model.coefficients[0]), float(model.intercept))]
        out = spark.createDataFrame(rows, "slope double, intercept double")
        return out.select(half_even("slope", 4).alias("slope"), half_even("intercept", 3).alias("intercept"))

    return run


def _early_stop(spark, d):
    """Boosting that ends once its patience does."""
    stopped = G.fit_boosting(split(spark, d, "train"), split(spark, d, "val"), EARLY)
    found = _metrics(spark, d, "boosting_early_stop", stopped)
    return found.withColumns({"best_iteration": F.lit(stopped.best_iteration), "rounds": F.lit(len(stopped.losses))})


def _boosting_stump(spark, d):
    """One round on one feature: the split and the leaf weights have a closed form."""
    rows = labelled(spark, d).where("split = 'train'").select("trip_key", "duration", F.col("fare_signal").alias("label"))
    rows = VectorAssembler(inputCols=["duration"], outputCol="features").transform(rows)
    tree = G.fit_boosting(rows, rows.where("false"), STUMP).trees[0]
    row = (tree.bound[0], tree.weight[tree.left[0]], tree.weight[tree.right[0]], tree.gain[0])
    out = spark.createDataFrame([row], "bound double, left_weight double, right_weight double, gain double")
    return out.select("bound", *[half_even(c, n).alias(c) for c, n in (("left_weight", 6), ("right_weight", 6), ("gain", 1))])


def _tree_line(spark, d):
    """Leaves of a least-squares tree on one feature whose minimum split size ends it after the root."""
    rows = labelled(spark, d).where("split = 'train'").select("trip_key", "duration", F.col("fare_signal").alias("label"))
    rows = VectorAssembler(inputCols=["duration"], outputCol="features").transform(rows)
    tree = G.fit_regression_tree(rows, 20, min_split=int(0.6 * rows.count()), bins=STUMP.bins).trees[0]
    leaves = [(i, w) for i, w in enumerate(w for f, w in zip(tree.feature, tree.weight, strict=True) if f < 0)]
    return spark.createDataFrame(leaves, "leaf int, mean double").select("leaf", half_even("mean", 6).alias("mean"))


def _stacking(spark, d):
    bases = {
        "forest": lambda t: M.fit_bagged(t, **STACK["forest"]),
        "gbt": lambda t: M.fit_gbt(t, **STACK["gbt"]),
        "boosting": lambda t: M.fit_gbt(t, **STACK["boosting"]),
    }
    stacked = M.fit_stacking(split(spark, d, "train").withColumn("fold", F.col("stack_fold")), bases, STACK_FOLDS)
    return _metrics(spark, d, "stacking", stacked)


def _ridge_search(spark, d):
    train = split(spark, d, "train")
    ridge, lasso = U.search_linear(train, "ridge", RIDGE_ALPHAS), U.search_linear(train, "lasso", LASSO_ALPHAS)
    tree = U.grid_search(
        train, DecisionTreeRegressor(seed=42), U.grid({"maxDepth": [3, 6], "minInstancesPerNode": [1, 4]}), FOLDS
    )
    named = [r.frame(train).withColumn("model", F.lit(n)) for n, r in (("ridge", ridge), ("lasso", lasso), ("tree", tree))]
    return named[0].unionByName(named[1]).unionByName(named[2])


def _line_rows(spark, d):
    """All rows with the feature ``duration``, folds and shares."""
    shares = {"fold": M.fold_column("split_key", FOLDS), "share_bucket": bucket("split_key", "share"), "label": F.col("fare_signal")}
    return labelled(spark, d).withColumns(shares)


def _path_line(spark, d):
    found = U.regularization_path(_line_rows(spark, d), PATH_ALPHAS, ["duration"])
    return found.select("model", "alpha", "split", half_even("r2", 8).alias("r2"))


def _curve_line(spark, d):
    found = U.linear_learning_curve(_line_rows(spark, d).where("split = 'train'"), "linear", 0.0, SHARES, ["duration"])
    numbers = [c for c in found.columns if c != "share"]
    return found.select("share", *[half_even(c, 8).alias(c) for c in numbers])


def _search_line(spark, d):
    cells = S.product_sums(_line_rows(spark, d).where("split = 'train'"), ["fold"], ["duration"])
    rows = [(k, *row) for k in ("ridge", "lasso") for row in S.cross_validated(cells, k, PATH_ALPHAS)]
    return spark.createDataFrame(rows, "model string, alpha double, rmse double").select("model", "alpha", half_even("rmse", 6).alias("rmse"))


def _random_search(spark, d):
    train = split(spark, d, "train")
    space = {
        "numTrees": [5, 10],
        "maxDepth": [4, 6],
        "minInstancesPerNode": [1, 2, 4],
        "featureSubsetStrategy": ["sqrt", "0.5", "0.7"],
    }
    return U.random_search(train, RandomForestRegressor(seed=42), space, 3, FOLDS).frame(train)


def _tune(spark, d):
    train, val = split(spark, d, "train"), split(spark, d, "val")
    found = U.tune_random(train, val, U.boosting_draws(TRIALS, TRIAL_TREES))
    params = F.lit(str(found.params))
    return _metrics(spark, d, "gbt_tuned", found.model).withColumn("params", params)


def _model_report(spark, d):
    """Name, features, intercept and metrics of the linear model as one record."""
    model = _fit(spark, d, "linear")
    names = training_table(spark, d)[1].feature_names
    nested = IO.nest_metrics(_metrics(spark, d, "linear", model))
    return nested.select(
        "model",
        F.lit(len(names)).alias("n_features"),
        F.array(*map(F.lit, names)).alias("feature_names"),
        "metrics",
        F.lit(round(float(model.intercept), 4)).alias("intercept"),
    )


def _model_roundtrip(spark, d):
    """Differences between the predictions of a model and of its reloaded copy: none."""
    path = scratch_path(spark, "model")
    model = PipelineModel([_fit(spark, d, "forest")])
    model.write().overwrite().save(path)
    data = split(spark, d, "test")
    first = model.transform(data).select("trip_key", "prediction")
    again = PipelineModel.load(path).transform(data).select("trip_key", F.col("prediction").alias("reloaded"))
    both = first.join(again, "trip_key")
    return both.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("prediction") != F.col("reloaded")).alias("different")
    )


def _importances(spark, d, names=("linear", "ridge", "lasso", "tree", "forest", "gbt")):
    models = {n: _fit(spark, d, n) for n in names}
    return I.importance_all(spark, models, training_table(spark, d)[1].feature_names)


# --- closed-form models: checked against SQL -------------------------------


def _simple_metrics(spark, d):
    return E.metrics_by_split(simple_predictions(spark, d), ["model"])


def _of_model(rows, name, part=None):
    out = rows.where(F.col("model") == name)
    return out if part is None else out.where(F.col("split") == part)


def _flatten(spark, d):
    nested = IO.nest_metrics(_simple_metrics(spark, d))
    path = scratch_path(spark, "metrics-json")
    IO.write_json(nested, path)
    return IO.flatten_metrics(IO.read_json(spark, path, IO.metrics_schema()))


def _run_log(spark, d):
    """Metrics appended to a stored log, one append per model."""
    path = scratch_path(spark, "run-log")
    metrics = materialize(_simple_metrics(spark, d), "metrics")
    params = F.create_map(F.lit("label"), F.lit("fare_signal"))
    for name in ("duration_line", "class_mean", "channel_mean"):
        lines = E.run_log(_of_model(metrics, name), params, F.lit("closed_form"))
        lines.write.mode("append").parquet(path)
    return IO.read_parquet(spark, path)


def _alias_timeline(spark, d):
    """The champion by each split in turn, appended to a stored alias log."""
    path, runs = scratch_path(spark, "alias-log"), _run_log(spark, d)
    for at, split in enumerate(("train", "val", "test"), 1):
        L.champion_event(runs, f"{split}_r2", "champion", F.lit(at)).write.mode("append").parquet(path)
    return L.alias_timeline(IO.read_parquet(spark, path))


def _run_lines(spark, d):
    return _run_log(spark, d).select("model", "model_type", "metric", "value", F.to_json("params").alias("params"))


def _union_metrics(spark, d):
    metrics = materialize(_simple_metrics(spark, d), "metrics")
    parts = [metrics.where(F.col("split") == s) for s in ("train", "val", "test")]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def _scoring_pipeline(spark, d):
    rows = labelled(spark, d).where("split = 'train'").select("duration", F.log1p("fare_signal").alias("label"))
    assembler = VectorAssembler(inputCols=["duration"], outputCol="features")
    model = M.fit_linear(materialize(assembler.transform(rows), "one-feature"))
    return PipelineModel([assembler, model])


def _requests(spark, d):
    return labelled(spark, d).where("split = 'test'").select("trip_key", "duration")


def _score_batch(spark, d):
    scored = V.score(_requests(spark, d), _scoring_pipeline(spark, d))
    return scored.select("trip_key", "predicted")


def _score_stream(spark, d):
    """The batch's rows arrive as files and are scored by the same function."""
    pipeline = _scoring_pipeline(spark, d)
    arriving, sink, state = (scratch_path(spark, n) for n in ("requests", "scored", "stream-state"))
    IO.write_parquet(_requests(spark, d), arriving)
    schema = T.StructType([T.StructField("trip_key", T.StringType()), T.StructField("duration", T.DoubleType())])
    rows = file_stream(spark, arriving, schema)
    query = start_scoring(rows, lambda r: V.score(r, pipeline).select("trip_key", "predicted"), sink, state)
    query.awaitTermination()
    return IO.read_parquet(spark, sink)


def _validate(spark, d):
    checked = V.validate(B.gaps(spark, d), V.REQUEST_RULES, ["airline", "seasonality"])
    return checked.select("trip_key", F.concat_ws(",", "reasons").alias("reasons"), (F.size("reasons") == 0).alias("valid"))


def _score_features(spark, d):
    """Fitted state applied to new rows, aligned to the fitted feature list."""
    flights = B.flights(spark, d)
    model = X.fit_features(flights, FQ.CONFIG)
    rows = flights.withColumn("split", B.split_of("split_key")).where("split = 'test'")
    return FQ._rounded(FQ.aligned(model.transform_wide(rows), ["trip_key"]))


def queries():
    return {
        "fit_linear": _line("fit_linear"),
        "fit_ridge": _line("fit_ridge"),
        "fit_lasso": _line("fit_lasso"),
        "fit_tree": _fit_metrics("tree"),
        "fit_forest": _fit_metrics("forest"),
        "fit_gbt": _fit_metrics("gbt"),
        "fit_gbt_early_stop": _early_stop,
        "boosting_stump": _boosting_stump,
        "tree_min_split": _tree_line,
        "fit_stacking": _stacking,
        "grid_search": _ridge_search,
        "random_search": _random_search,
        "tune_random": _tune,
        "model_report": _model_report,
        "model_roundtrip": _model_roundtrip,
        "regularization_path": lambda s, d: U.regularization_path(training_table(s, d)[0], PATH_ALPHAS),
        "learning_curve": lambda s, d: U.linear_learning_curve(split(s, d, "train"), "ridge", 1.0, SHARES),
        "regularization_path_line": _path_line,
        "learning_curve_line": _curve_line,
        "linear_search_line": _search_line,
        "coef_importance": lambda s, d: _importances(s, d, ("linear",)),
        "tree_importance": lambda s, d: _importances(s, d, ("forest",)).limit(20),
        "importance_all": lambda s, d: _importances(s, d),
        "importance_top10": lambda s, d: I.top_features(_importances(s, d)),
        "lasso_zeroed": lambda s, d: I.zeroed(_importances(s, d, ("lasso",))),
        "importance_agreement": lambda s, d: I.agreement(_importances(s, d, ("linear", "forest", "gbt")), ["forest", "gbt", "linear"]),
        "importance_side_by_side": lambda s, d: I.side_by_side(_importances(s, d, ("linear", "lasso")), "linear", "lasso"),
        "regression_metrics": lambda s, d: E.regression_metrics(simple_predictions(s, d), ["model"]),
        "metrics_by_split": _simple_metrics,
        "metrics_original_scale": lambda s, d: E.metrics_by_split(simple_predictions(s, d, True), ["model"], True),
        "fit_diagnosis": lambda s, d: E.fit_diagnosis(_simple_metrics(s, d)),
        "model_comparison": _simple_metrics,
        "union_metrics": _union_metrics,
        "metrics_long": lambda s, d: E.metrics_long(_simple_metrics(s, d)),
        "metrics_json_flatten": _flatten,
        "residual_stats": lambda s, d: E.residual_histogram(_of_model(simple_predictions(s, d), "duration_line", "test")),
        "residual_summary": lambda s, d: E.residual_summary(_of_model(simple_predictions(s, d), "class_mean", "test")),
        "actual_vs_predicted": _actual,
        "leaderboard": lambda s, d: L.leaderboard(_simple_metrics(s, d)),
        "champion_run": lambda s, d: L.champion(_run_log(s, d)).select("model", "metric", "value"),
        "champion_alias": lambda s, d: L.alias_holders(_alias_timeline(s, d), F.lit(2)),
        "champion_timeline": _alias_timeline,
        "run_log": _run_lines,
        "validate_rows": _validate,
        "score_features": _score_features,
        "score_batch": _score_batch,
        "score_stream": _score_stream,
    }


def _actual(spark, d):
    rows = _of_model(simple_predictions(spark, d), "duration_line", "test")
    out = E.actual_vs_predicted(materialize(rows, "predictions"), 3000, ["trip_key"])
    numbers = ("label", "prediction", "axis_min", "axis_max")
    return out.select("trip_key", *[half_even(c, 4).alias(c) for c in numbers])


TEST_ROWS = "WHERE split = 'test'"
METRICS_SQL = (
    "round_even(1 - sum((label - prediction) ** 2) / (var_pop(label) * count(*)), 4) AS r2, "
    "round_even(avg(abs(label - prediction)), 2) AS mae, "
    "round_even(sqrt(avg((label - prediction) ** 2)), 2) AS rmse, "
    "round_even(avg(abs((label - prediction) / nullif(label, 0))) * 100, 2) AS mape"
)


def oracles():
    scored = f"WITH {scored_sql()} "
    by_split = f"SELECT model, split, {METRICS_SQL} FROM scored GROUP BY model, split"
    long = f"SELECT model, split, metric, value FROM ({by_split}) UNPIVOT (value FOR metric IN (r2, mae, rmse, mape))"
    line = f"WITH {B.SIGNAL_SQL}, t AS (SELECT duration AS x, fare_signal AS y FROM labelled WHERE split = 'train'), m AS (SELECT avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) AS sxy, var_pop(x) * count(*) AS sxx, count(*) AS n FROM t) "

    def slope(expr: str) -> str:
        return line + f"SELECT round_even(s, 4) AS slope, round_even(my - s * mx, 3) AS intercept FROM (SELECT *, {expr} AS s FROM m)"

    residual = "(SELECT label - prediction AS e FROM scored WHERE model = 'duration_line' AND split = 'test')"
    hist = (
        f"SELECT CAST(least(floor((e - lo) / w), 79) AS INTEGER) AS bin, lo, w, n, m, s FROM {residual}, "
        f"(SELECT min(e) AS lo, (max(e) - min(e)) / 80.0 AS w, count(*) AS n, avg(e) AS m, stddev_pop(e) AS s FROM {residual})"
    )
    rules = {c: f"{c} IS NOT NULL" for c in ("airline", "seasonality")} | V.REQUEST_RULES
    reasons = ", ".join(f"CASE WHEN NOT coalesce({r}, false) THEN '{n}' END" for n, r in rules.items())
    predicted = (
        f"WITH {B.SIGNAL_SQL}, m AS (SELECT regr_slope(ln(1 + fare_signal), duration) AS s, regr_intercept(ln(1 + fare_signal), duration) AS b FROM labelled WHERE split = 'train') "
        "SELECT trip_key, round_even(exp(b + s * duration) - 1, 2) AS predicted FROM labelled, m WHERE split = 'test'"
    )
    stump_rows = (
        f"WITH {B.SIGNAL_SQL}, t AS (SELECT duration AS x, fare_signal AS y FROM labelled WHERE split = 'train'), "
        "s AS (SELECT x, count(*) AS n, sum((SELECT avg(y) FROM t) - y) AS g FROM t GROUP BY x), "
        "c AS (SELECT x, sum(g) OVER (ORDER BY x) AS gl, sum(n) OVER (ORDER BY x) AS nl, sum(g) OVER () AS g, sum(n) OVER () AS n FROM s) "
    )
    points = ", ".join(f"({a}::DOUBLE)" for a in PATH_ALPHAS)
    cells = (
        f"WITH {B.SIGNAL_SQL}, r AS (SELECT duration AS x, fare_signal AS y, split, {B.bucket_sql('split_key', 'fold-42', FOLDS)} AS fold, "
        f"{B.bucket_sql('split_key', 'share')} AS b FROM labelled), alphas AS (SELECT * FROM (VALUES {points}) t(alpha)), "
    )
    stats = "count(*) AS n, avg(x) AS mx, avg(y) AS my, covar_pop(x, y) * count(*) AS sxy, var_pop(x) * count(*) AS sxx"
    sloped = (
        "SELECT 'ridge' AS model, alpha, sxy / (sxx + alpha) AS s, * EXCLUDE (alpha) FROM t, alphas UNION ALL "
        "SELECT 'lasso', alpha, sign(sxy) * greatest(abs(sxy) / n - alpha, 0) / (sxx / n), * EXCLUDE (alpha) FROM t, alphas"
    )
    error = "sum((y - my - s * (x - mx)) ** 2)"
    steps = ", ".join(f"({a}::DOUBLE, {round(1000 * a)})" for a in SHARES)
    path_line = (
        cells + f"t AS (SELECT {stats} FROM r WHERE split = 'train'), m AS ({sloped}) SELECT model, alpha, split, "
        f"round_even(1 - {error} / (var_pop(y) * count(*)), 8) AS r2 FROM m, r WHERE split IN ('train', 'val') GROUP BY model, alpha, split"
    )
    search_line = (
        cells + f"tr AS (SELECT * FROM r WHERE split = 'train'), t AS (SELECT k.fold, {stats} FROM (SELECT DISTINCT fold FROM tr) k JOIN tr ON tr.fold <> k.fold "
        f"GROUP BY k.fold), m AS ({sloped}), e AS (SELECT model, alpha, fold, sqrt({error} / count(*)) AS e FROM m JOIN tr USING (fold) GROUP BY model, alpha, fold) "
        "SELECT model, alpha, round_even(avg(e), 6) AS rmse FROM e GROUP BY model, alpha"
    )
    curve_line = (
        cells + f"shares AS (SELECT * FROM (VALUES {steps}) v(share, upto)), tr AS (SELECT * FROM r WHERE split = 'train'), "
        f"t AS (SELECT share, upto, k.fold, {stats} FROM shares, (SELECT DISTINCT fold FROM tr) k JOIN tr ON tr.fold <> k.fold WHERE b < upto GROUP BY share, upto, k.fold), "
        "m AS (SELECT *, sxy / sxx AS s FROM t), "
        f"a AS (SELECT share, m.fold, any_value(n) AS n, 1 - {error} / (var_pop(y) * count(*)) AS r2 FROM m JOIN tr ON tr.fold <> m.fold AND b < upto GROUP BY share, m.fold), "
        f"v AS (SELECT share, m.fold, 1 - {error} / (var_pop(y) * count(*)) AS r2 FROM m JOIN tr ON tr.fold = m.fold GROUP BY share, m.fold) "
        "SELECT share, round_even(avg(n), 8) AS rows, round_even(avg(a.r2), 8) AS train_r2_mean, round_even(stddev_pop(a.r2), 8) AS train_r2_std, "
        "round_even(avg(v.r2), 8) AS val_r2_mean, round_even(stddev_pop(v.r2), 8) AS val_r2_std FROM a JOIN v USING (share, fold) GROUP BY share"
    )
    sample = "SELECT * FROM scored WHERE model = 'duration_line' AND split = 'test' ORDER BY md5(trip_key || '|42') LIMIT 3000"
    event = "SELECT * FROM (SELECT model, 'champion' AS alias, {at} AS since FROM ({rows}) WHERE split = '{split}' ORDER BY r2 DESC NULLS LAST, model LIMIT 1)"
    log = " UNION ALL ".join(event.format(at=at, rows=by_split, split=split) for at, split in enumerate(("train", "val", "test"), 1))
    timeline = (
        "SELECT alias, model, CAST(row_number() OVER (PARTITION BY model ORDER BY since) AS INTEGER) AS version, "
        f"since AS valid_from, lead(since) OVER (ORDER BY since) AS valid_until FROM ({log})"
    )
    return {
        "boosting_stump": stump_rows + "SELECT x AS bound, round_even(-0.3::DOUBLE * gl / (nl + 1), 6) AS left_weight, "
        "round_even(-0.3::DOUBLE * (g - gl) / (n - nl + 1), 6) AS right_weight, "
        "round_even((gl * gl / (nl + 1) + (g - gl) * (g - gl) / (n - nl + 1) - g * g / (n + 1)) / 2, 1) AS gain "
        "FROM c WHERE nl < n ORDER BY gl * gl / (nl + 1) + (g - gl) * (g - gl) / (n - nl + 1) DESC, x LIMIT 1",
        "tree_min_split": stump_rows + ", b AS (SELECT * FROM c WHERE nl < n ORDER BY gl * gl / nl + (g - gl) * (g - gl) / (n - nl) DESC, x LIMIT 1) "
        "SELECT CAST(leaf AS INTEGER) AS leaf, round_even(m, 6) AS mean FROM (SELECT 0 AS leaf, avg(y) AS m FROM t, b WHERE t.x <= b.x "
        "UNION ALL SELECT 1, avg(y) FROM t, b WHERE t.x > b.x)",
        "regularization_path_line": path_line,
        "learning_curve_line": curve_line,
        "linear_search_line": search_line,
        "fit_linear": slope("sxy / sxx"),
        "fit_ridge": slope(f"sxy / (sxx + {ONE_ALPHA['ridge']})"),
        "fit_lasso": slope(f"sign(sxy) * greatest(abs(sxy) / n - {ONE_ALPHA['lasso']}, 0) / (sxx / n)"),
        "regression_metrics": scored + f"SELECT model, {METRICS_SQL} FROM scored GROUP BY model",
        "metrics_by_split": scored + by_split,
        "metrics_original_scale": f"WITH {scored_sql(True)} SELECT model, split, {METRICS_SQL} FROM "
        "(SELECT model, split, exp(label) - 1 AS label, exp(prediction) - 1 AS prediction FROM scored) GROUP BY model, split",
        "fit_diagnosis": scored
        + "SELECT model, train_r2, val_r2, round_even(train_r2 - val_r2, 4) AS gap, CASE WHEN train_r2 - val_r2 > 0.05 THEN 'overfit' "
        "WHEN val_r2 < 0.5 THEN 'underfit' ELSE 'ok' END AS diagnosis FROM (SELECT model, max(r2) FILTER (WHERE split = 'train') AS train_r2, "
        f"max(r2) FILTER (WHERE split = 'val') AS val_r2 FROM ({by_split}) GROUP BY model)",
        "model_comparison": scored + by_split,
        "union_metrics": scored + by_split,
        "metrics_long": scored + long,
        "metrics_json_flatten": scored + long,
        "residual_stats": scored
        + "SELECT bin, round_even(lo + bin * w, 4) AS left_edge, round_even(lo + (bin + 1) * w, 4) AS right_edge, count(*) AS count, "
        f"round_even(count(*) / (n * w), 8) AS density, round_even(m, 4) AS mean, round_even(s, 4) AS std FROM ({hist}) GROUP BY bin, lo, w, n, m, s",
        "residual_summary": scored
        + "SELECT round_even(avg(e), 4) AS mean, round_even(stddev_samp(e), 4) AS std, round_even(skewness(e), 4) AS skew, "
        "round_even(count(*) FILTER (WHERE e > 0) * 100.0 / count(e), 2) AS under_pct, round_even(count(*) FILTER (WHERE e < 0) * 100.0 / count(e), 2) AS over_pct "
        f"FROM {residual.replace('duration_line', 'class_mean')}",
        "actual_vs_predicted": scored
        + f", p AS ({sample}) SELECT trip_key, round_even(label, 4) AS label, round_even(prediction, 4) AS prediction, "
        "round_even((SELECT min(least(label, prediction)) FROM p), 4) AS axis_min, round_even((SELECT max(greatest(label, prediction)) FROM p), 4) AS axis_max FROM p",
        "leaderboard": scored
        + f"SELECT *, CAST(row_number() OVER (PARTITION BY split ORDER BY r2 DESC, model) AS INTEGER) AS rank FROM ({by_split})",
        "champion_run": scored
        + f"SELECT model, 'test_r2' AS metric, r2 AS value FROM ({by_split}) WHERE split = 'test' ORDER BY r2 DESC, model LIMIT 1",
        "champion_alias": scored
        + f"SELECT alias, model, version FROM ({timeline}) WHERE valid_from = 2",
        "champion_timeline": scored + timeline,
        "run_log": scored
        + f"SELECT model, 'closed_form' AS model_type, split || '_' || metric AS metric, value, '{{\"label\":\"fare_signal\"}}' AS params FROM ({long})",
        "validate_rows": f"WITH {B.GAPS_SQL} SELECT trip_key, concat_ws(',', {reasons}) AS reasons, "
        f"concat_ws(',', {reasons}) = '' AS valid FROM gaps",
        "score_features": f"WITH {FQ.ROWS_SQL} SELECT * EXCLUDE (split, label) FROM ({FQ.flow_sql(TEST_ROWS)})",
        "score_batch": predicted,
        "score_stream": predicted,
    }


