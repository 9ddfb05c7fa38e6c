"""Running totals and average ranks over a whole column, without a single-task sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tabforge.session import materialize

ROWS_PER_CHUNK = 500_000
MAX_CHUNKS = 1_000


def running_total(cells: DataFrame, group: str, order: str, weight: str, out: str) -> DataFrame:
    """Adds the running sum of ``weight`` by ``order`` within each ``group``.

    ``cells`` is a stored table with distinct ``order`` values per group. Each
    group is cut into value ranges, ranges are summed in parallel, and only the
    totals of the ranges (at most ``MAX_CHUNKS`` per group) go through a window
    of their own. The cut points are collected as plain numbers: they are few,
    and they must not change if a stage is run again.
    """
    return running_totals(cells, group, order, {out: weight})


def running_totals(cells: DataFrame, group: str, order: str, weights: dict[str, str]) -> DataFrame:
    """``running_total`` of several columns at once, by the name of the sum."""
    chunks = min(MAX_CHUNKS, cells.count() // ROWS_PER_CHUNK + 1)
    if chunks == 1:
        within = Window.partitionBy(group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
        return cells.withColumns({out: F.sum(weight).over(within) for out, weight in weights.items()})
    probs = [i / chunks for i in range(1, chunks)]
    cuts = {
        row[0]: sorted(set(row[1]))
        for row in cells.groupBy(group).agg(F.percentile_approx(order, probs, 10 * chunks)).collect()
    }
    chunk = F.lit(None).cast("int")
    for name, values in cuts.items():
        bounds = F.array(*map(F.lit, values))
        below = F.size(F.filter(bounds, lambda b: b < F.col(order)))
        chunk = F.when(F.col(group) == name, below).otherwise(chunk)
    placed = cells.withColumn("_chunk", chunk)
    before = Window.partitionBy("_g").orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
    sums = [F.sum(weight).alias(f"_t_{out}") for out, weight in weights.items()]
    totals = placed.groupBy(F.col(group).alias("_g"), F.col("_chunk").alias("_i")).agg(*sums)
    below = [F.coalesce(F.sum(f"_t_{out}").over(before), F.lit(0)).alias(f"_offset_{out}") for out in weights]
    offsets = materialize(totals.select("_g", "_i", *below), "chunk-offsets")
    within = Window.partitionBy(group, "_chunk").orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        placed.withColumns({f"_part_{out}": F.sum(weight).over(within) for out, weight in weights.items()})
        .join(offsets, (F.col(group) == F.col("_g")) & (F.col("_chunk") == F.col("_i")))
        .withColumns({out: F.col(f"_part_{out}") + F.col(f"_offset_{out}") for out in weights})
        .drop(*[f"_{kind}_{out}" for kind in ("part", "offset") for out in weights], "_chunk", "_g", "_i")
    )


def rank_tables(df: DataFrame, columns: list[str]) -> DataFrame:
    """Average rank (ties share the mean place) of every distinct value of each column.

    Stored by column, so that the join of one column reads, and is sized by,
    that column's values only.
    """
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "value")
    counts = long.where(F.col("value").isNotNull()).groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    cells = materialize(counts, "value-counts")
    ranked = running_total(cells, "column", "value", "n", "upto")
    rank = F.col("upto") - (F.col("n") - 1) / 2
    return materialize(ranked.select("value", rank.alias("rank"), "column"), "ranks", partition_by=["column"])


def with_ranks(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replaces each column by its average ranks.

    A rank table under the broadcast threshold is broadcast; a larger one
    (continuous columns) is joined by shuffle on the value.
    """
    tables = rank_tables(df, columns)
    out = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    for c in columns:
        one = tables.where(F.col("column") == c).select(F.col("value").alias("_v"), F.col("rank").alias(f"_r_{c}"))
        out = out.join(one, F.col(c) == F.col("_v"), "left").drop("_v")
    return out.select(*[F.col(f"_r_{c}").alias(c) for c in columns])
