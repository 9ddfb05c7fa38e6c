"""Training tables of the model queries, derived from the test tables.

The label is ``fare_signal``; the numeric columns of ``trips`` say nothing
about ``fare`` itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.hashing import bucket
from tabforge.operators import features as X
from tabforge.operators import models as M
from tabforge.operators.lookups import lookup_default
from tabforge.plans import trips as B
from tabforge.session import materialize

FOLDS, STACK_FOLDS = 5, 3
CONFIG = X.FeatureConfig(
    target="fare_signal",
    categorical=B.CATEGORIES,
    numerical=tuple(B.NUMERICAL),
    split_key="split_key",
    redundant=("source_name", "destination_name"),
    target_encode=("route",),
    log_numeric=("days_left",),
)

_built: dict[tuple[str, str], tuple[DataFrame, X.FeatureModel]] = {}


def labelled(spark: SparkSession, d: str) -> DataFrame:
    return B.signal(B.flights(spark, d))


def training_table(spark: SparkSession, d: str) -> tuple[DataFrame, X.FeatureModel]:
    """Feature vectors of all rows by split, with folds. Built once per session and data folder.

    Fits pass over the table many times, so it is stored, by split, instead of
    being joined and encoded again on every pass. The splits are written side by
    side, as sorting a task's vectors by split would hold all of them, and in
    small row groups, so that the tasks of a fit can be small. Spark writes the
    parts of the vectors, which are read back as vectors.
    """
    key = (spark.sparkContext.applicationId, d)
    if key not in _built:
        rows = labelled(spark, d)
        model = X.fit_features(rows, CONFIG)
        vectors = model.transform_parts(X.labelled(rows, CONFIG)).select(
            "trip_key",
            "features",
            "label",
            M.fold_column("split_key", FOLDS).alias("fold"),
            M.fold_column("split_key", STACK_FOLDS, 7).alias("stack_fold"),
            bucket("split_key", "share").alias("share_bucket"),
            "split",
        )
        with M.small_tasks(rows):
            _built[key] = (materialize(vectors, "training", ["split"], B.ROW_GROUP, open_files=3, schema=X.vector_schema(vectors)), model)
    return _built[key]


def split(spark: SparkSession, d: str, name: str) -> DataFrame:
    return training_table(spark, d)[0].where(F.col("split") == name)


def simple_predictions(spark: SparkSession, d: str, log: bool = False) -> DataFrame:
    """Rows ``(model, trip_key, split, label, prediction)`` of three closed-form models.

    ``duration_line`` is least squares on one feature; ``class_mean`` and
    ``channel_mean`` predict the training mean of a category.
    """
    rows = labelled(spark, d).select("trip_key", "split", "duration", "travel_class", "booking_source", "fare_signal")
    y = F.log1p("fare_signal") if log else F.col("fare_signal")
    rows = rows.withColumn("label", y)
    train = rows.where(F.col("split") == "train")
    slope, start = train.agg(F.regr_slope("label", "duration"), F.regr_intercept("label", "duration")).first()
    for c in ("travel_class", "booking_source"):
        means, mean = X.target_means(train, c, "label")
        rows = lookup_default(rows, means, c, "mean", F.lit(mean), f"_{c}")
    guesses = {
        "duration_line": F.lit(start) + F.lit(slope) * F.col("duration"),
        "class_mean": F.col("_travel_class"),
        "channel_mean": F.col("_booking_source"),
    }
    return rows.select("trip_key", "split", "label", *[c.alias(n) for n, c in guesses.items()]).unpivot(
        ["trip_key", "split", "label"], list(guesses), "model", "prediction"
    )


def scored_sql(log: bool = False) -> str:
    y = "ln(1 + fare_signal)" if log else "fare_signal"
    return (
        B.SIGNAL_SQL
        + f""",
y AS (SELECT *, {y} AS label FROM labelled),
line AS (SELECT regr_slope(label, duration) AS s, regr_intercept(label, duration) AS b FROM y WHERE split = 'train'),
cls AS (SELECT travel_class, avg(label) AS m FROM y WHERE split = 'train' GROUP BY 1),
chn AS (SELECT booking_source, avg(label) AS m FROM y WHERE split = 'train' GROUP BY 1),
scored AS (
  SELECT trip_key, split, label, 'duration_line' AS model, b + s * duration AS prediction FROM y, line
  UNION ALL SELECT trip_key, split, label, 'class_mean', m FROM y JOIN cls USING (travel_class)
  UNION ALL SELECT trip_key, split, label, 'channel_mean', m FROM y JOIN chn USING (booking_source)
)"""
    )
