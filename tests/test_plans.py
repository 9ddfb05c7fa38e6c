"""Plan shapes, streaming and file round trips."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tabforge.operators import features as X
from tabforge.operators import models as M
from tabforge.operators import scoring as V
from tabforge.plans import model_data
from tabforge.plans import trips as B
from tabforge.session import setting
from tabforge.sources import tables as IO
from tabforge.streaming.scoring import file_stream, start_scoring

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )


CHECKED = ["summary_grouping_sets", "insight_bundle", "boxplot_stats", "kde_grid", "corr_spearman", "feature_flow", "metrics_by_split", "lookup_default"]


@pytest.mark.parametrize("name", CHECKED)
def test_no_cross_join_and_no_global_window(spark, name):
    df = entry.queries()[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    # A window line lists its functions, then its partition keys, then its order.
    for line in (x for x in plan.splitlines() if "Window [" in x):
        lists = line.split("], [")
        assert len(lists) > 1 and " ASC" not in lists[1] and " DESC" not in lists[1], line


def test_scan_pushes_filter_and_prunes_columns(spark):
    plan = _plan(entry.queries()["scan_parquet"](spark, SF))
    assert "PushedFilters: [IsNotNull(l_quantity)" in plan
    assert "l_shipdate" not in plan


def test_split_filter_prunes_directories(spark, tmp_path):
    path = str(tmp_path / "s")
    IO.write_splits(spark.range(30).withColumn("split", B.split_of("id")), path)
    plan = _plan(IO.load_splits(spark, path, ["val"]))
    assert "PartitionFilters: [isnotnull(split" in plan or "PartitionFilters: [split" in plan


def test_missing_path(spark):
    with pytest.raises(FileNotFoundError):
        IO.read_parquet(spark, "/tmp/no/such/file.parquet")
    with pytest.raises(FileNotFoundError):
        IO.read_csv(spark, "/tmp/no/such/file.csv")


def test_round_trips_keep_shape_types_and_rows(spark, tmp_path):
    df = B.flights(spark, SF).select("trip_key", "airline", "stopovers", "duration", "days_left", "fare").limit(500)
    for name, write, read in (
        ("p", IO.write_parquet, lambda p: IO.read_parquet(spark, p)),
        ("c", IO.write_csv, lambda p: IO.read_csv(spark, p, df.schema)),
        ("j", IO.write_json, lambda p: IO.read_json(spark, p, df.schema)),
    ):
        path = str(tmp_path / name)
        write(df, path)
        assert IO.same_table(df, read(path)), name
    inferred = dict(IO.read_csv(spark, str(tmp_path / "c")).dtypes)
    assert inferred["fare"] == "double" and inferred["stopovers"] == "int"


def test_splits_share_no_key(spark):
    rows = X.labelled(model_data.labelled(spark, SF), model_data.CONFIG).select("split_key", "split").distinct()
    assert rows.groupBy("split_key").count().where("count > 1").isEmpty()


def test_stream_scores_like_the_batch(spark, tmp_path):
    rows = model_data.labelled(spark, SF)
    model = X.fit_features(rows, model_data.CONFIG)
    train = model.transform(X.labelled(rows, model_data.CONFIG)).where("split = 'train'").select("features", "label")
    fitted = M.fit_linear(train)

    def score(r):
        checked = V.accepted(V.validate(r, V.REQUEST_RULES))
        return V.score(checked, fitted, model.transform, log_target=False).select("trip_key", "predicted")

    requests = rows.where("split = 'test'").drop("split", "fare_signal", "fare")
    arriving = str(tmp_path / "in")
    requests.repartition(3).write.parquet(arriving)
    stored = spark.read.parquet(arriving)
    query = start_scoring(file_stream(spark, arriving, stored.schema, 1), score, str(tmp_path / "out"), str(tmp_path / "chk"))
    query.awaitTermination()
    streamed, batch = spark.read.parquet(str(tmp_path / "out")), score(stored)
    assert streamed.count() > 0 and IO.same_table(streamed, batch)


def test_model_quality_on_the_signal_label(spark):
    table = model_data.training_table(spark, "/root/testdata/sf0.01")[0]
    from tabforge.operators.evaluation import metrics_by_split

    model = M.fit_linear(table.where("split = 'train'"))
    scored = metrics_by_split(M.predict_splits(model, table, "linear"))
    assert scored.agg(F.min("r2")).first()[0] > 0.94


def test_lines_are_not_moved_by_their_customer(spark):
    with setting(spark, "spark.sql.autoBroadcastJoinThreshold", -1):
        plan = _plan(B.joined_trips(spark, SF))
    assert "SortMergeJoin" in plan and "hashpartitioning(l_partkey" in plan
    assert "hashpartitioning(o_custkey" not in plan


def test_splits_are_written_side_by_side(spark, monkeypatch):
    from tabforge import session

    seen, real = [], session.setting
    monkeypatch.setattr(session, "setting", lambda s, name, value: seen.append((name, value)) or real(s, name, value))
    rows = spark.range(30).withColumn("split", F.concat(F.lit("s"), F.col("id") % 3))
    out = session.materialize(rows, "sides", ["split"], 2**20, open_files=3)
    assert out.count() == 30 and out.where("split = 's1'").count() == 10
    assert seen == [("spark.sql.maxConcurrentOutputFileWriters", 3)]


def test_the_joins_have_tasks_in_proportion_to_the_lines(spark, monkeypatch):
    lines, name = spark.range(95), "spark.sql.shuffle.partitions"
    before = int(spark.conf.get(name))
    monkeypatch.setattr(B, "LINES", 1)
    with B.join_tasks(lines):
        assert int(spark.conf.get(name)) == max(before, 95)
    assert int(spark.conf.get(name)) == before
    monkeypatch.setattr(B, "LINES", 95)
    with B.join_tasks(lines):
        assert int(spark.conf.get(name)) == before
