from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from tabforge.operators import features as X
from tabforge.operators.lookups import lookup_default
from tabforge.session import materialize

CONFIG = X.FeatureConfig(
    target="fare",
    categorical=("airline", "travel_class"),
    numerical=("duration", "days_left", "stopovers"),
    split_key="id",
    redundant=("source_name",),
    target_encode=("route",),
    log_numeric=("days_left",),
)


@pytest.fixture(scope="module")
def table(spark):
    i = F.col("id")
    return spark.range(600).select(
        "id",
        F.element_at(F.array(*map(F.lit, ["AA", "BB", "CC"])), (i % 3 + 1).cast("int")).alias("airline"),
        F.when(i % 2 == 0, "DAC").otherwise("CGP").alias("source"),
        F.lit("long name").alias("source_name"),
        F.when(i % 5 == 0, "DXB").otherwise("LHR").alias("destination"),
        F.when(i % 7 == 0, None).when(i % 4 == 0, "First").otherwise("Economy").alias("travel_class"),
        (i % 13 + 1.5).alias("duration"),
        (i % 180 - 5).alias("days_left"),
        F.lit(1).alias("stopovers"),
        (1000 + i * 3.0).alias("fare"),
    ).cache()


def test_split_is_disjoint_exhaustive_and_stable(table):
    rows = X.labelled(table, CONFIG).select("id", "split")
    assert rows.count() == 600 and rows.select("id").distinct().count() == 600
    again = X.labelled(table.repartition(1), CONFIG).select("id", "split")
    assert rows.exceptAll(again).isEmpty()
    sizes = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    assert abs(sizes["train"] - 420) < 60 and abs(sizes["val"] - 60) < 35


@pytest.mark.parametrize("n", [100, 1000])
def test_exact_split_sizes(spark, n):
    rows = X.exact_split(spark.range(n), "id")
    sizes = {r["split"]: r["count"] for r in rows.groupBy("split").count().collect()}
    assert sizes == {"train": round(0.7 * n), "val": round(0.1 * n), "test": round(0.2 * n)}


def test_interaction(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "s string, d string")
    assert [r["r"] for r in X.interaction(df, "s", "d", "r").collect()] == ["a_b", None]
    assert X.interaction(df, "s", "absent", "r").columns == ["s", "d"]


def test_one_hot_wide(table):
    out = X.one_hot_wide(table.select("id", "travel_class", "fare"), ["travel_class"], "fare")
    assert out.columns == ["id", "travel_class_Economy", "travel_class_First", "fare"]
    empty = out.where("id % 7 = 0").agg(F.sum(F.col("travel_class_Economy") + F.col("travel_class_First"))).first()[0]
    assert empty == 0
    assert X.one_hot_wide(table.select("travel_class"), ["travel_class"], drop_first=True).columns == ["travel_class_First"]


def test_vocabulary_cap(table):
    with pytest.raises(ValueError, match="too many values"):
        X.vocabulary(table, ["airline"]).words(cap=2)


def test_vocabulary_index_of_many_values(spark):
    """Numbered in the order of the values across many ranges, and used without a value on the driver."""
    df = spark.range(200_000).select(F.concat(F.lit("v"), F.col("id") * 7919 % 200_003).alias("c"), (F.col("id") % 3).cast("string").alias("k"), F.col("id"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = X.vocabulary(df, ["c", "absent", "k"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert found.sizes == {"c": 200_000, "k": 3}
    values = [r["value"] for r in found.table.where("column = 'c'").orderBy("index").collect()]
    assert values == sorted(values) and len(set(values)) == 200_000
    assert found.table.where("column = 'c'").agg(F.min("index"), F.max("index"), F.countDistinct("index")).first() == (0, 199_999, 200_000)
    model = X.FeatureModel(X.FeatureConfig("y", ("c", "k"), (), "id", interaction=None), found, {}, None)
    row = model.transform(df.where("id = 5")).first()
    assert row["features"].size == 200_003 and row["features"].indices.tolist() == [values.index(row["c"]), 200_002]
    assert X.vocabulary(df.where("false"), ["k"]).sizes == {"k": 0} and X.vocabulary(df, ["absent"]) is None


def test_log_numeric_clips(spark):
    df = spark.createDataFrame([(-3.0,), (0.0,), (math.e - 1,), (None,)], "x double")
    assert [r["x"] for r in X.log_numeric(df, ["x"]).collect()] == [0.0, 0.0, pytest.approx(1.0), None]


def test_scaler_uses_population_std_and_survives_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, c double")
    state = X.scaler_state(df, ["x", "c", "absent"])
    assert state == {"x": (2.0, 1.0), "c": (5.0, 1.0)}
    assert [tuple(r) for r in X.standardize(df, state).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_target_encoding_sees_training_labels_only(table):
    changed = table.withColumn("fare", F.when(X.split_column("id") == "train", F.col("fare")).otherwise(9e9))
    a, b = X.fit_features(table, CONFIG), X.fit_features(changed, CONFIG)
    assert a.global_mean == b.global_mean and a.scaler == b.scaler
    assert a.lookups["route"].exceptAll(b.lookups["route"]).isEmpty()


def test_lookup_default_for_unseen_and_missing(spark):
    df = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    means = spark.createDataFrame([("a", 2.0)], "k string, mean double")
    out = lookup_default(df, means, "k", "mean", F.lit(7.0), "te").collect()
    assert [r["te"] for r in out] == [2.0, 7.0, 7.0]


def test_flow_invariants(table):
    model = X.fit_features(table, CONFIG)
    out = X.feature_set(table, model, ("id",))
    assert out.count() == 600
    assert "fare" not in model.feature_names and "route_te" in model.feature_names
    assert not {"route", "source_name", "airline"} & set(out.columns)
    train = out.where("split = 'train'").agg(F.avg("duration"), F.stddev_pop("duration")).first()
    assert train[0] == pytest.approx(0, abs=1e-9) and train[1] == pytest.approx(1, abs=1e-9)
    with pytest.raises(KeyError):
        X.labelled(table.drop("fare"), CONFIG)
    with pytest.raises(KeyError):
        X.split_features_target(table, "nope")


def test_vector_equals_wide(table):
    model = X.fit_features(table, CONFIG)
    rows = X.labelled(table, CONFIG)
    wide = {r["id"]: r for r in model.transform_wide(rows).collect()}
    for r in model.transform(rows).where("id < 40").collect():
        assert r["features"].toArray().tolist() == [float(wide[r["id"]][n]) for n in model.feature_names]


def test_stored_parts_are_the_vectors(spark, table):
    rows = X.labelled(table.withColumn("airline", F.when(F.col("id") % 3 == 0, F.lit("new")).otherwise(F.col("airline"))), CONFIG)
    model = X.fit_features(table, CONFIG)
    parts = model.transform_parts(rows)
    assert "ArrowEvalPython" not in parts._jdf.queryExecution().executedPlan().toString()
    back = materialize(parts.select("id", "features"), "parts", schema=X.vector_schema(parts.select("id", "features")))
    made = {r["id"]: r["features"] for r in model.transform(rows).select("id", "features").collect()}
    assert {r["id"]: r["features"] for r in back.collect()} == made and len(made) == 600


def test_a_missing_number_is_no_part_of_a_vector(table):
    rows = X.labelled(table.withColumn("duration", F.when(F.col("id") != 5, F.col("duration"))), CONFIG)
    with pytest.raises(Exception, match="a feature is missing"):
        X.fit_features(table, CONFIG).transform_parts(rows).select("features").collect()


def test_unseen_category_and_reload(spark, table, tmp_path):
    model = X.fit_features(table, CONFIG)
    model.save(spark, str(tmp_path / "m"))
    again = X.FeatureModel.load(spark, str(tmp_path / "m"))
    odd = table.limit(1).withColumn("airline", F.lit("ZZ")).withColumn("source", F.lit("XXX"))
    row = again.transform_wide(odd).first()
    assert row["airline_AA"] == row["airline_BB"] == row["airline_CC"] == 0
    assert row["route_te"] == model.global_mean
    assert again.feature_names == model.feature_names
