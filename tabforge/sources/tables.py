"""Readers and writers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_MISSING_PATH = "PATH_NOT_FOUND"


def _load(reader, path: str) -> DataFrame:
    try:
        return reader(path)
    except AnalysisException as e:
        if e.getCondition() == _MISSING_PATH:
            raise FileNotFoundError(f"no data at {path}") from e
        raise


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, **options) -> DataFrame:
    """CSV with a header row. Without ``schema`` the types are inferred, which costs one more scan."""
    reader = spark.read.option("header", True).options(**options)
    if schema is None:
        return _load(reader.option("inferSchema", True).csv, path)
    return _load(reader.schema(schema).csv, path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """A parquet scan; with ``schema`` no file footer has to be read to plan it."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return _load(reader.parquet, path)


def read_json(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return _load(reader.json, path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One JSON object per row; NULL fields are kept so that every record has the same keys."""
    df.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def write_text(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").text(path)


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> None:
    """Feature set as one dataset, one directory per split."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)


def load_splits(spark: SparkSession, path: str, splits: list[str] | None = None, split_col: str = "split") -> DataFrame:
    """Reads the named splits; the filter prunes the other directories."""
    df = read_parquet(spark, path)
    return df if splits is None else df.where(F.col(split_col).isin(splits))


def flatten_metrics(df: DataFrame, metrics: tuple[str, ...] = ("r2", "mae", "rmse", "mape")) -> DataFrame:
    """``(model, metrics: map<split, struct>)`` rows as model x split x metric."""
    wide = df.select("model", F.explode("metrics").alias("split", "m")).select(
        "model", "split", *[F.col(f"m.{m}").alias(m) for m in metrics]
    )
    return wide.unpivot(["model", "split"], list(metrics), "metric", "value")


def metrics_schema(metrics: tuple[str, ...] = ("r2", "mae", "rmse", "mape")) -> T.StructType:
    inner = T.StructType([T.StructField(m, T.DoubleType()) for m in metrics])
    return T.StructType(
        [T.StructField("model", T.StringType()), T.StructField("metrics", T.MapType(T.StringType(), inner))]
    )


def nest_metrics(wide: DataFrame, metrics: tuple[str, ...] = ("r2", "mae", "rmse", "mape")) -> DataFrame:
    """Model x split rows as one ``(model, metrics)`` record per model."""
    entry = F.struct("split", F.struct(*metrics))
    return wide.groupBy("model").agg(F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("metrics"))


def same_table(a: DataFrame, b: DataFrame) -> bool:
    """Same column names and types, and the same rows with multiplicity."""
    shape = [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]
    return shape and a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
