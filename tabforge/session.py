"""Shared storage for intermediate results.

Multi-pass operators write their small (or expensive) intermediate tables to
the folder named by ``spark.checkpoint.dir`` and read them back.  That cuts the
lineage in a way that survives lost executors, pins values that a recomputation
might not reproduce (sketches), and gives Catalyst a real size: a table that
comes back under ``spark.sql.autoBroadcastJoinThreshold`` is broadcast, a
larger one is joined by shuffle.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

_fallback: dict[str, str] = {}


def work_dir(spark: SparkSession) -> str:
    """Folder for this application's intermediates, on storage all executors share."""
    app = spark.sparkContext.applicationId
    base = spark.conf.get("spark.checkpoint.dir", None)
    master = spark.sparkContext.master
    if not base and not master.startswith("local[") and master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not base:
        # Only single-machine sessions (tests) run without the setting.
        if app not in _fallback:
            _fallback[app] = tempfile.mkdtemp(prefix="tabforge-")
        base = _fallback[app]
    return f"{base.rstrip('/')}/tabforge-{app}"


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{work_dir(spark)}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str = "stage", partition_by: list[str] | None = None, row_group: int | None = None, open_files: int = 0, schema: StructType | None = None) -> DataFrame:
    """Write ``df`` as parquet to the shared folder and return a scan of it.

    A task reads whole row groups, so the bytes of a ``row_group`` say how finely
    a file can be shared among tasks, whatever the number of tasks that wrote it.
    With up to ``open_files`` partitions a task writes them side by side, a row
    group of memory each, and does not sort its rows by partition first. The
    scan has another ``schema`` where one is given that is stored the same way.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.mode("overwrite")
    if row_group:
        writer = writer.option("parquet.block.size", row_group)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    with setting(df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters", open_files):
        writer.parquet(path)
    return df.sparkSession.read.schema(schema or df.schema).parquet(path)


@contextmanager
def setting(spark: SparkSession, name: str, value: str | int) -> Iterator[None]:
    """A session setting for the jobs that run inside the block."""
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(value))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
