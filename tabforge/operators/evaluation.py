"""Regression metrics, comparison tables and residual analysis."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import half_even, percent, sample_skewness
from tabforge.operators.distributions import histogram
from tabforge.operators.lookups import sample_n

METRICS = ("r2", "mae", "rmse", "mape")


def regression_metrics(
    df: DataFrame, by: list[str] | None = None, label: str = "label", prediction: str = "prediction"
) -> DataFrame:
    """r2, mae, rmse and mape (zero labels ignored) from one aggregation per group of ``by``.

    A constant label has r2 1 when predicted exactly and 0 otherwise; one row has none.
    """
    y, p = F.col(label), F.col(prediction)
    error = y - p
    n = F.count(error).cast("double")
    sse = F.sum(error * error)
    sst = F.var_pop(y) * n
    r2 = F.when(n < 2, None).when(sst > 0, 1.0 - F.try_divide(sse, sst)).otherwise(F.when(sse == 0, 1.0).otherwise(0.0))
    relative = F.abs(F.try_divide(error, y))
    aggs = [
        half_even(r2, 4).alias("r2"),
        half_even(F.avg(F.abs(error)), 2).alias("mae"),
        half_even(F.sqrt(F.avg(error * error)), 2).alias("rmse"),
        half_even(F.avg(relative) * 100, 2).alias("mape"),
    ]
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def original_scale(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Undoes the ``log1p`` of label and prediction."""
    return df.withColumns({label: F.expm1(label), prediction: F.expm1(prediction)})


def metrics_by_split(df: DataFrame, by: list[str] | None = None, log_target: bool = False, **names) -> DataFrame:
    """Metrics per split (and ``by``); with ``log_target`` on the original scale."""
    rows = original_scale(df) if log_target else df
    return regression_metrics(rows, [*(by or []), "split"], **names)


def fit_diagnosis(metrics: DataFrame) -> DataFrame:
    """Overfit when train r2 exceeds val r2 by more than 0.05, underfit when val r2 is under 0.5."""
    wide = metrics.groupBy("model").agg(
        F.max(F.when(F.col("split") == "train", F.col("r2"))).alias("train_r2"),
        F.max(F.when(F.col("split") == "val", F.col("r2"))).alias("val_r2"),
    )
    gap = F.col("train_r2") - F.col("val_r2")
    verdict = F.when(gap > 0.05, "overfit").when(F.col("val_r2") < 0.5, "underfit").otherwise("ok")
    return wide.select("model", "train_r2", "val_r2", half_even(gap, 4).alias("gap"), verdict.alias("diagnosis"))


def metrics_long(metrics: DataFrame) -> DataFrame:
    return metrics.unpivot(["model", "split"], list(METRICS), "metric", "value")


def residuals(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    r = F.col(label) - F.col(prediction)
    return df.withColumns({"residual": r, "abs_residual": F.abs(r)})


def residual_histogram(df: DataFrame, bins: int = 80) -> DataFrame:
    """Histogram of the residuals with their mean and (population) std beside it."""
    rows = residuals(df)
    stats = rows.agg(F.avg("residual").alias("m"), F.stddev_pop("residual").alias("s"))
    return (
        histogram(rows, "residual", bins)
        .drop("scale")
        .withColumn("mean", half_even(stats.select("m").scalar(), 4))
        .withColumn("std", half_even(stats.select("s").scalar(), 4))
    )


def residual_summary(df: DataFrame) -> DataFrame:
    """Mean, std, skew and the shares of rows predicted too low and too high."""
    r = F.col("residual")
    n = F.count(r)
    return residuals(df).agg(
        half_even(F.avg(r), 4).alias("mean"),
        half_even(F.stddev_samp(r), 4).alias("std"),
        half_even(sample_skewness(r), 4).alias("skew"),
        half_even(percent(F.count_if(r > 0), n), 2).alias("under_pct"),
        half_even(percent(F.count_if(r < 0), n), 2).alias("over_pct"),
    )


def actual_vs_predicted(df: DataFrame, n: int, by: list[str], seed: int = 42) -> DataFrame:
    """A sample of (label, prediction) pairs with the common axis range of the sample."""
    picked = sample_n(df.select(*by, "label", "prediction"), n, seed, by)
    low, high = F.least("label", "prediction"), F.greatest("label", "prediction")
    edges = picked.agg(F.min(low).alias("lo"), F.max(high).alias("hi"))
    return picked.withColumns(
        {"axis_min": edges.select("lo").scalar(), "axis_max": edges.select("hi").scalar()}
    )


def run_log(metrics: DataFrame, params: Column, model_type: Column) -> DataFrame:
    """Model x split metrics as log lines: run, metric name ``split_metric``, value, parameters."""
    lines = metrics_long(metrics)
    return lines.select(
        "model",
        model_type.alias("model_type"),
        F.concat_ws("_", "split", "metric").alias("metric"),
        "value",
        params.alias("params"),
    )
