from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from tabforge.operators.quantiles import column_stats, group_stats
from tabforge.operators.ranks import running_total, with_ranks
from tabforge.session import materialize

PROBS = {"p0": 0.0, "p10": 0.1, "p25": 0.25, "median": 0.5, "p75": 0.75, "p99": 0.99, "p100": 1.0}


def _frame(spark, rows):
    return spark.createDataFrame(rows, "g string, x double")


@pytest.mark.parametrize("values", ["continuous", "ties", "spike"])
def test_brackets_are_exact_for_hot_groups(spark, values):
    rng = np.random.default_rng(3)
    n = 12_000
    x = {
        "continuous": np.round(rng.lognormal(8, 1, n), 2),
        "ties": rng.integers(0, 7, n).astype(float),
        "spike": np.where(rng.random(n) < 0.6, 5.0, rng.normal(0, 100, n)),
    }[values]
    g = np.where(rng.random(n) < 0.7, "hot", rng.choice(["a", "b", "c"], n))
    df = _frame(spark, list(zip(g.tolist(), x.tolist(), strict=True)))
    # every group is narrowed several times before its rows are listed
    out = group_stats(df, ["g"], "x", PROBS, ("mean",), bins=8, listed=20).collect()
    assert len(out) == 4
    for row in out:
        own = x[g == row["g"]]
        assert row["count"] == len(own)
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(np.quantile(own, p), rel=1e-15, abs=1e-12), (row["g"], name)


def test_binned_and_listed_agree(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), (F.col("id") * 37 % 4999).cast("double").alias("x"))
    a = group_stats(df, ["g"], "x", PROBS, (), bins=16, listed=10)
    b = group_stats(df, ["g"], "x", PROBS, ())
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


def test_missing_values_single_rows_and_null_keys(spark):
    rows = [("a", 1.0), ("a", None), ("a", float("nan")), ("a", 4.0), ("b", None), ("c", 7.0), (None, 2.0)]
    out = {r["g"]: r for r in group_stats(_frame(spark, rows), ["g"], "x", {"m": 0.5}, ("mean", "std")).collect()}
    assert (out["a"]["count"], out["a"]["m"]) == (2, 2.5)
    assert (out["b"]["count"], out["b"]["m"], out["b"]["mean"]) == (0, None, None)
    assert (out["c"]["m"], out["c"]["std"]) == (7.0, None)
    assert out[None]["m"] == 2.0


def test_groups_of_millions_and_a_whole_column(spark):
    df = spark.range(6_000_000).select(
        F.when(F.col("id") % 6 < 5, "hot").otherwise("cold").alias("g"), F.pow(F.rand(1) * 10, F.lit(5)).alias("x")
    )
    df = materialize(df)
    wanted = {"q": 0.25, "m": 0.5, "t": 0.999}
    own = df.toPandas()
    for row in group_stats(df, ["g"], "x", wanted, ()).collect():
        assert [row[k] for k in wanted] == pytest.approx(np.quantile(own.x[own.g == row["g"]], list(wanted.values())).tolist(), rel=1e-14)
    row = column_stats(df, ["x"], wanted, ()).first()
    assert [row[k] for k in wanted] == pytest.approx(np.quantile(own.x, list(wanted.values())).tolist(), rel=1e-14)


def test_extreme_values(spark):
    rows = [("a", float(v)) for v in (-1.7e308, 1.7e308, 0.0, 1e-300, 5e-324, 1.0, 2.0)] + [("i", float("inf")), ("i", float("-inf")), ("i", 3.0)]
    out = {r["g"]: r for r in group_stats(_frame(spark, rows), ["g"], "x", {"lo": 0.0, "m": 0.5, "hi": 1.0}, (), bins=4, listed=1).collect()}
    assert (out["a"]["lo"], out["a"]["m"], out["a"]["hi"]) == (-1.7e308, 1e-300, 1.7e308)
    assert (out["i"]["lo"], out["i"]["m"], out["i"]["hi"]) == (float("-inf"), 3.0, float("inf"))


def test_empty_table(spark):
    assert group_stats(_frame(spark, []), ["g"], "x", {"m": 0.5}).collect() == []


def test_approximate_is_one_pass_and_close(spark):
    df = spark.range(10_001).select(F.lit("a").alias("g"), F.col("id").cast("double").alias("x"))
    row = group_stats(df, ["g"], "x", {"m": 0.5}, approximate=True, accuracy=1000).first()
    assert abs(row["m"] - 5000) <= 20


def test_column_stats_covers_all_columns(spark):
    df = spark.range(5).select(F.col("id").alias("a"), (F.col("id") * 2.5).alias("b"))
    out = {r["column"]: r["m"] for r in column_stats(df, ["a", "b"], {"m": 0.5}).collect()}
    assert out == {"a": 2.0, "b": 5.0}


def test_running_total_in_chunks(spark, monkeypatch):
    import tabforge.operators.ranks as R

    monkeypatch.setattr(R, "ROWS_PER_CHUNK", 50)
    df = spark.range(900).select(
        F.when(F.col("id") < 700, "hot").otherwise("cold").alias("g"),
        (F.col("id") * 7919 % 1009).cast("double").alias("v"),
        (F.col("id") % 5 + 1).alias("n"),
    )
    got = running_total(materialize(df), "g", "v", "n", "upto").orderBy("g", "v").collect()
    want = df.toPandas().sort_values(["g", "v"])
    want["upto"] = want.groupby("g")["n"].cumsum()
    assert [r["upto"] for r in got] == want["upto"].tolist()


def test_average_ranks_with_ties(spark):
    df = spark.createDataFrame([(3.0,), (1.0,), (3.0,), (2.0,), (3.0,)], "x double")
    assert sorted(r["x"] for r in with_ranks(df, ["x"]).collect()) == [1.0, 2.0, 4.0, 4.0, 4.0]
