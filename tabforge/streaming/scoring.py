"""Scoring of arriving rows with Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def file_stream(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int | None = None) -> DataFrame:
    """Parquet files that arrive in ``path``, as a stream."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def start_scoring(
    rows: DataFrame,
    score: Callable[[DataFrame], DataFrame],
    sink: str,
    checkpoint: str,
    available_now: bool = True,
) -> StreamingQuery:
    """Scores the stream into a parquet folder.

    Scoring is stateless: each micro-batch is a narrow job (the fitted lookups
    are joined as static tables). The file sink and the checkpoint together
    give each row exactly once, also after a restart.
    """
    writer = score(rows).writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.outputMode("append").start()
