from __future__ import annotations

import datetime as dt

import pytest

from tabforge.operators import cleaning as K
from tabforge.operators.lookups import align_columns, reindex, sample_n, unknown_values

CONFIG = K.CleaningConfig(
    rename={"Airline": "airline", "Total Fare": "fare", "Base Fare": "base_fare", "Departure": "departure_datetime", "Stops": "stopovers"},
    leakage=("Base Fare",),
    timestamps=("departure_datetime",),
    ordinal={"stopovers": ("Direct", "1 Stop", "2 Stops")},
)


def test_drop_unnamed_any_case(spark):
    df = spark.createDataFrame([(1, 2, 3)], ["Unnamed: 0", "unnamed_1", "fare"])
    assert K.drop_unnamed(df).columns == ["fare"]
    assert K.drop_unnamed(df.select("fare")).columns == ["fare"]


def test_rename_ignores_absent_names(spark):
    df = spark.createDataFrame([("x", 1)], ["Airline", "Other"])
    assert K.rename_columns(df, {"Airline": "airline", "Nope": "nope"}).columns == ["airline", "Other"]


def test_drop_columns_maps_raw_names(spark):
    df = spark.createDataFrame([(1, 2)], ["base_fare", "fare"])
    assert K.drop_columns(df, ["Base Fare"], CONFIG.rename).columns == ["fare"]
    assert K.drop_columns(df, ["Missing"]).columns == ["base_fare", "fare"]


def test_sparse_rows_floor(spark):
    names = [f"c{i}" for i in range(15)]
    schema = ", ".join(f"{n} int" for n in names)
    rows = [tuple(1 if i < k else None for i in range(15)) for k in (6, 7, 15)]
    assert K.drop_sparse_rows(spark.createDataFrame(rows, schema), 0.5).count() == 2


def test_impute_median_mean_and_text(spark):
    df = spark.createDataFrame([(2.0, 1, "a"), (None, None, None), (6.0, 4, "b")], "x double, n int, t string")
    rows = K.impute_missing(df, "median", "Unknown").collect()
    assert (rows[1]["x"], rows[1]["n"], rows[1]["t"]) == (4.0, 2.5, "Unknown")
    assert K.imputation_values(df, "mean") == {"x": 4.0, "n": 2.5}
    assert K.imputation_values(df.dropna()) == {}
    with pytest.raises(ValueError, match="unknown strategy"):
        K.imputation_values(df, "mode")


def test_mixed_timestamps(spark):
    df = spark.createDataFrame([("2024-06-15 08:30:00",), ("11/17/2025 06:25",), ("2024-01-02",), (None,)], "t string")
    rows = [r["t"] for r in K.parse_timestamps(df, ["t"]).collect()]
    assert rows == [dt.datetime(2024, 6, 15, 8, 30), dt.datetime(2025, 11, 17, 6, 25), dt.datetime(2024, 1, 2), None]


@pytest.mark.parametrize("bad", ["bad", "2024-02-31", "31/31/2024"])
def test_bad_timestamp(spark, bad):
    df = spark.createDataFrame([(bad,)], "t string")
    assert K.parse_timestamps(df, ["t"], "null").first()["t"] is None
    with pytest.raises(Exception, match="Unexpected value in 't'"):
        K.parse_timestamps(df, ["t"]).collect()
    with pytest.warns(UserWarning, match="not found"):
        K.parse_timestamps(df, ["absent"])


def test_temporal_parts_of_a_saturday(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 6, 15, 8, 30),)], "departure_datetime timestamp_ntz")
    out = K.temporal_features(df, ["departure_datetime"])
    assert out.columns == ["departure_hour", "departure_day_of_week", "departure_month"]
    assert tuple(out.first()) == (8, 5, 6)


def test_ordinal(spark):
    df = spark.createDataFrame([("Direct",), ("2 Stops",)], "s string")
    assert [r["s"] for r in K.ordinal_encode(df, "s", ["Direct", "1 Stop", "2 Stops"]).collect()] == [0, 2]
    assert K.ordinal_encode(df, "absent", ["a"]).columns == ["s"]
    for text in ("3 Stops", None):
        odd = spark.createDataFrame([(text,)], "s string")
        with pytest.raises(Exception, match="Unexpected value"):
            K.ordinal_encode(odd, "s", ["Direct"]).collect()
        assert K.ordinal_encode(odd, "s", ["Direct"], "null").first()["s"] is None


def test_flow_and_report(spark):
    rows = [
        (0, "A", 10.0, 8.0, "2024-01-01 10:00:00", "Direct"),
        (1, None, None, 7.0, "1/2/2024 9:30", "1 Stop"),
        (2, None, None, None, None, None),
        (3, "B", 30.0, 7.0, "2024-01-06", "2 Stops"),
    ]
    names = ["Unnamed: 0", "Airline", "Total Fare", "Base Fare", "Departure", "Stops"]
    df = spark.createDataFrame(rows, "`Unnamed: 0` int, Airline string, `Total Fare` double, `Base Fare` double, Departure string, Stops string")
    assert df.columns == names
    out = K.clean_flow(df, CONFIG)
    got = {r["departure_day_of_week"]: r for r in out.collect()}
    assert set(got) == {0, 1, 5}
    assert (got[1]["airline"], got[1]["fare"], got[1]["stopovers"]) == ("Unknown", 20.0, 1)
    report = K.cleaning_report(df, out, CONFIG).first()
    assert (report["initial_rows"], report["final_rows"], report["rows_removed"]) == (4, 3, 1)
    assert (report["initial_cols"], report["final_cols"]) == (6, 6)


def test_lookup_helpers(spark):
    df = spark.createDataFrame([("a", 1), ("b", 2), (None, 3)], "k string, v int")
    assert {r["k"] for r in unknown_values(df, "k", ["a"]).collect()} == {"b", None}
    assert [(r["k"], r["v"]) for r in reindex(df, "k", ["b", "z"]).orderBy("position").collect()] == [("b", 2), ("z", None)]
    assert align_columns(df, ["v", "w"]).collect()[0].asDict() == {"v": 1, "w": 0}
    big = spark.range(1000)
    a = {r["id"] for r in sample_n(big, 50).collect()}
    assert len(a) == 50 and a == {r["id"] for r in sample_n(big.repartition(7), 50).collect()}
