"""Lookups, reindexing, set operations, sampling and ranking."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.hashing import digest_of_row


def lookup_default(df: DataFrame, table: DataFrame, key: str, value: str, default: Column, out: str) -> DataFrame:
    """Adds ``out`` = the table's value for ``key``; unknown and missing keys get ``default``.

    ``table`` has one row per key. Its size decides the join: broadcast under
    the session's threshold, otherwise a shuffle join whose hot keys AQE splits.
    """
    side = table.select(F.col(key).alias("_key"), F.col(value).alias("_value"))
    joined = df.join(side, F.col(key) == F.col("_key"), "left")
    return joined.withColumn(out, F.coalesce(F.col("_value"), default)).drop("_key", "_value")


def align_outer(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Side-by-side combination of two keyed tables; keys of either side are kept."""
    return left.join(right, key, "full_outer")


def with_overall_mean(df: DataFrame, value: str, out: str) -> DataFrame:
    """Every row next to the mean over all rows, as a scalar subquery."""
    return df.withColumn(out, df.agg(F.avg(value)).scalar())


def reindex(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Exactly the listed keys, in their order, with NULLs where ``df`` has none."""
    wanted = df.sparkSession.createDataFrame(
        [(i, k) for i, k in enumerate(order)],
        T.StructType([T.StructField("position", T.IntegerType()), T.StructField("_want", T.StringType())]),
    )
    kept = df.where(F.col(key).isin(order))
    return wanted.join(kept, F.col("_want") == F.col(key), "left").drop(key).withColumnRenamed("_want", key)


def set_intersect(*sets: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.intersect(b), sets)


def unknown_values(df: DataFrame, column: str, allowed: list[str]) -> DataFrame:
    """Observed values outside the allowed list (a missing value counts as one)."""
    seen = F.col(column)
    return df.where(seen.isNull() | ~seen.isin(allowed)).select(column).distinct()


def align_columns(df: DataFrame, expected: list[str], keep: list[str] | None = None) -> DataFrame:
    """Exactly the expected columns in order: absent ones are 0, others are dropped."""
    present = set(df.columns)
    return df.select(*(keep or []), *[F.col(c) if c in present else F.lit(0).alias(c) for c in expected])


def sample_n(df: DataFrame, n: int, seed: int = 42, by: list[str] | None = None) -> DataFrame:
    """``n`` rows without replacement: those with the smallest salted row hash.

    Planned as a top-n, so each task passes on at most ``n`` rows.
    """
    keys = by or df.columns
    digest = digest_of_row(keys, seed)
    return df.withColumn("_h", digest).orderBy("_h").limit(n).drop("_h")


def leaderboard(metrics: DataFrame, metric: str = "r2") -> DataFrame:
    """Rank of the models within each split (one row per model and split)."""
    place = Window.partitionBy("split").orderBy(F.col(metric).desc_nulls_last(), "model")
    return metrics.withColumn("rank", F.row_number().over(place))


def champion(runs: DataFrame, metric: str = "test_r2") -> DataFrame:
    """The run with the highest value of ``metric`` in a long run log."""
    scored = runs.where(F.col("metric") == metric)
    return scored.orderBy(F.col("value").desc_nulls_last(), "model").limit(1)


def champion_event(runs: DataFrame, metric: str, alias: str, at: Column) -> DataFrame:
    """One line for an append-only alias log: the champion by ``metric`` gets ``alias`` at time ``at``."""
    return champion(runs, metric).select("model", F.lit(alias).alias("alias"), at.alias("at"))


def alias_timeline(events: DataFrame) -> DataFrame:
    """Who held which alias when, from a log of (model, alias, at).

    Each registration of a model is its next version. A version holds its alias
    from ``at`` until the next event of that alias (null: still does). Of events
    at the same time the last by model name wins. An event without a model only
    takes the alias away; repeated lines count once.
    """
    once = events.select("model", "alias", "at").distinct()
    version = F.row_number().over(Window.partitionBy("model").orderBy("at", "alias"))
    until = F.lead("at").over(Window.partitionBy("alias").orderBy("at", F.col("model").asc_nulls_first()))
    held = once.withColumns({"version": version, "valid_until": until}).where(F.col("model").isNotNull())
    lasting = F.col("valid_until").isNull() | (F.col("valid_until") > F.col("at"))
    return held.where(lasting).select("alias", "model", "version", F.col("at").alias("valid_from"), "valid_until")


def alias_holders(timeline: DataFrame, at: Column) -> DataFrame:
    """The version that holds each alias at a time."""
    open_end = F.col("valid_until").isNull() | (F.col("valid_until") > at)
    return timeline.where((F.col("valid_from") <= at) & open_end).select("alias", "model", "version")
