from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tabforge.functions.numeric import half_even
from tabforge.operators import correlation as C
from tabforge.operators import distributions as D
from tabforge.operators import profiling as P
from tabforge.operators import scoring as V
from tabforge.operators import summaries as S


def test_half_even(spark):
    df = spark.createDataFrame([(0.125, 2.5), (0.375, 3.5), (-0.125, -2.5)], "a double, b double")
    rows = df.select(half_even("a", 2), half_even("b")).collect()
    assert [tuple(r) for r in rows] == [(0.12, 2.0), (0.38, 4.0), (-0.12, -2.0)]
    ties = np.round(np.arange(0, 400) * 0.01 + 0.005, 3)
    got = spark.createDataFrame([(float(v),) for v in ties], "x double").select(half_even("x", 2).alias("r")).collect()
    assert [r["r"] for r in got] == np.round(ties, 2).tolist()


def test_pairwise_correlation_equals_dataframe_library(spark):
    rng = np.random.default_rng(5)
    p = pd.DataFrame(rng.normal(size=(400, 4)), columns=list("abcd"))
    p["b"] = p["b"] + 1e6
    p["d"] = p["a"] * 0.5 + p["d"]
    p.loc[rng.random(400) < 0.3, "a"] = np.nan
    p.loc[rng.random(400) < 0.3, "c"] = np.nan
    p["k"] = 3.0
    df = spark.createDataFrame(p).repartition(5)
    for method, got in (("pearson", C.corr_matrix(df, list("abck"), "d", 6)), ("spearman", C.corr_spearman(df, list("abck"), "d", 6))):
        want = p.corr(method=method)
        for r in got.collect():
            w = want.loc[r["feature_a"], r["feature_b"]]
            assert (r["r"] is None and np.isnan(w)) or r["r"] == pytest.approx(w, abs=2e-6), (method, r)


def test_correlation_without_complete_pairs(spark):
    df = spark.createDataFrame([(1.0, None), (None, 2.0)], "x double, y double")
    assert [r["r"] for r in C.corr_with_target(df, ["x"], "y").collect()] == [None]
    with pytest.warns(UserWarning, match="skipped"):
        C.corr_matrix(df, ["x", "z"], "y")


def test_constant_after_masking(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, None)], "x double, y double")
    assert C.corr_with_target(df, ["x"], "y").first()["r"] is None


def test_windows_are_right_closed(spark):
    days = [0, 1, 7, 8, 14, 15, 30, 31, 60, 90, 180, 365, 366, 9999, 10000, -5, None]
    df = spark.createDataFrame([(d,) for d in days], "d int")
    got = [r["w"] for r in df.select(S.booking_window("d").alias("w")).collect()]
    want = pd.cut(pd.Series(days, dtype="float"), S.WINDOW_EDGES, labels=S.WINDOW_LABELS, right=True)
    assert got == [None if pd.isna(w) else w for w in want]


def test_summary_matches_dataframe_library(spark):
    rng = np.random.default_rng(2)
    p = pd.DataFrame({"g": rng.choice(["x", "y", "z"], 300), "fare": np.round(rng.uniform(10, 999, 300), 2)})
    p.loc[::17, "fare"] = np.nan
    out = S.summary_by_group(spark.createDataFrame(p), "g", "fare").toPandas().set_index("g")
    grouped = p.groupby("g")["fare"]
    for name, want in {"mean": grouped.mean(), "median": grouped.median(), "std": grouped.std(), "p25": grouped.quantile(0.25), "p75": grouped.quantile(0.75)}.items():
        assert out[name].sort_index().tolist() == want.round(2).sort_index().tolist(), name
    assert out["count"].sort_index().tolist() == grouped.count().sort_index().tolist()


def test_absent_group_columns_and_baseline(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 3.0), (None, 8.0)], "g string, fare double")
    with pytest.warns(UserWarning, match="absent"):
        rows = S.summary_grouping_sets(df, ["g", "absent"], "fare").collect()
    assert [r["pct_vs_avg"] for r in rows] == [-25.0, -75.0]
    with_base = {r["g"]: r["pct_vs_regular"] for r in S.group_vs_baseline(df, "g", "fare", "a").collect()}
    without = {r["g"]: r["pct_vs_regular"] for r in S.group_vs_baseline(df, "g", "fare", "none").collect()}
    assert with_base == {"a": 0.0, "b": 200.0} and without == {"a": -75.0, "b": -25.0}


def test_fixed_order_puts_unknown_last(spark):
    df = spark.createDataFrame([("late", 1.0), ("peak", 2.0), ("odd", 3.0)], "s string, fare double")
    rows = S.pricing_fixed_order(df, "s", "fare", ["peak", "late"]).collect()
    assert [r["s"] for r in rows] == ["peak", "late", None]


def test_histogram_and_density(spark):
    x = np.random.default_rng(1).normal(50, 9, 2000)
    df = spark.createDataFrame([(float(v),) for v in x], "x double")
    rows = D.histogram(df, "x", 40).collect()
    counts = {r["bin"]: r["count"] for r in rows}
    assert [counts.get(b, 0) for b in range(40)] == np.histogram(x, 40)[0].tolist()
    curve = D.kde(df, "x", 60).toPandas()
    assert np.trapezoid(curve["density"], curve["x"]) == pytest.approx(1.0, abs=0.02)
    same = spark.createDataFrame([(2.0,), (2.0,)], "x double")
    assert D.histogram(same, "x", 10).collect()[0]["count"] == 2
    assert D.kde(same, "x").collect() == []


def test_boxplot(spark):
    df = spark.createDataFrame([("g", float(v)) for v in [1, 2, 3, 4, 5, 100]], "g string, x double")
    row = D.boxplot_stats(df, "g", "x").first()
    assert (row["whisker_low"], row["whisker_high"], row["outliers"], row["median"]) == (1.0, 5.0, 1, 3.5)


def test_profile(spark):
    df = spark.createDataFrame(
        [(1.0, "a", "2024-01-01", "1"), (None, "b", "1/2/2024 3:04", "2"), (1.0, "a", "2024-01-01", "1")],
        "x double, s string, t string, n string",
    ).withColumn("void", F.lit(None).cast("string"))
    assert P.timestamp_like(df) == ["t", "void"]
    assert {r["column"]: r["kind"] for r in P.classify_columns(df).collect()} == {
        "x": "numerical", "s": "categorical", "t": "datetime", "n": "categorical", "void": "datetime"
    }
    assert {r["column"]: r["missing_count"] for r in P.missing_audit(df).collect()} == {"x": 1, "void": 3}
    assert P.total_missing(df).first()[0] == 4
    assert tuple(P.duplicate_rows(df).first()) == (1, 33.33)
    assert P.duplicate_rows(df.limit(0)).first()["duplicate_rows"] == 0
    assert P.categorical_profile(df, ["s"]).first()["top"] == "a"
    assert P.numeric_profile(df, ["x"]).first()["skew"] is None


def test_each_request_rule(spark):
    good = {"stopovers": 1, "duration": 4.5, "days_left": 30, **{f"{s}_{p}": 1 for s in ("departure", "arrival") for p in ("hour", "day_of_week", "month")}}
    bad = {"stopovers": 3, "duration": 0.0, "days_left": 0, "departure_hour": 24, "departure_day_of_week": 7, "departure_month": 0, "arrival_hour": -1, "arrival_day_of_week": -1, "arrival_month": 13}
    rows = [good] + [{**good, k: v} for k, v in bad.items()] + [{**good, "duration": None}]
    schema = ", ".join(f"{k} {'double' if k == 'duration' else 'int'}" for k in good)
    checked = V.validate(spark.createDataFrame([tuple(r[k] for k in good) for r in rows], schema), V.REQUEST_RULES)
    assert [r["reasons"] for r in checked.collect()] == [[], *[[k] for k in bad], ["duration"]]
    assert V.accepted(checked).count() == 1 and V.rejected(checked).count() == 10


def test_rank_correlation_with_gaps_keeps_one_row_per_row(spark, monkeypatch):
    rng = np.random.default_rng(8)
    p = pd.DataFrame(rng.integers(0, 9, (300, 4)).astype(float), columns=list("abcd"))
    for c in "abd":
        p.loc[rng.random(300) < 0.3, c] = np.nan
    seen, real = [], C.correlations
    monkeypatch.setattr(C, "correlations", lambda rows, pairs: seen.append(rows.count()) or real(rows, pairs))
    want = p.corr(method="spearman")
    for r in C.corr_spearman(spark.createDataFrame(p), list("abc"), "d", 6).collect():
        assert r["r"] == pytest.approx(want.loc[r["feature_a"], r["feature_b"]], abs=2e-6)
    assert seen == [300, 300]
