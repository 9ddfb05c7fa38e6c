"""Mixing sources to target weights: whole copies of documents, the rest by a seeded Bernoulli draw."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.llm.columns import hash_unit, unused, without, word_count
from tabforge.session import materialize


def source_targets(
    sizes: DataFrame, weights: Sequence[float], share: float = 1.5, cap: float = 2.0, source: str = "source"
) -> DataFrame:
    """Target size of each source, from one row per source with its ``source_size``.

    Sources in code-point order (null last) weigh ``weights``, repeating, and
    share ``share`` times the total. No target exceeds ``cap`` times its source;
    the excess goes to the others by weight until none is above. That is a
    water level L with target = min(cap * size, L * weight): with the sources in
    the order of cap * size / weight, capping those before the k-th leaves
    (budget - their caps) / (weights from k on), and the largest of these is L.
    The rows are aggregates, one per source. All sources empty: targets are 0.
    """
    in_order = Window.orderBy(F.col(source).asc_nulls_last())
    choice = F.array(*[F.lit(float(w)) for w in weights])
    weighed = sizes.withColumn(
        "weight", F.element_at(choice, (F.row_number().over(in_order) - 1) % len(weights) + 1)
    ).withColumn("most", F.lit(float(cap)) * F.col("source_size"))
    by_level = Window.orderBy(F.col("most") / F.col("weight"), F.col(source).asc_nulls_last())
    before, whole = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(0))
    level = (
        F.lit(float(share)) * F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    ) / F.sum("weight").over(whole)
    return (
        weighed.withColumn("level", level)
        .withColumn("level", F.max("level").over(everything))
        .select(source, "source_size", F.least("most", F.col("level") * F.col("weight")).alias("target"))
    )


def plan_mix(
    docs: DataFrame,
    weights: Sequence[float] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    seed: int = 42,
    id_col: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
) -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``copies``; input columns of these names are replaced.

    A document of a source with rate = target / source_size is taken
    floor(rate) times, and once more if the hash of its id falls below the
    fraction, so its expected size is rate times its own and the seed alone
    decides. Sizes are summed per source before the shuffle; the targets are a
    stored table of one row per source, joined back without a hint, so a hot
    source needs no task of its own (AQE splits it where the table is too large
    to broadcast). Null texts have size 0; a null source is a source; repeated
    ids get the same decision; an empty table gives no rows.
    """
    added = ["size", "source_size", "target", "copies"]
    sized = docs.select(*without(docs, added), (word_count("text") if size is None else size).alias("size"))
    totals = sized.groupBy(source).agg(F.sum("size").alias("source_size"))
    targets = materialize(source_targets(totals, weights, share, cap, source), "mix-targets")
    (key,) = unused(sized, "mix_source")
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    extra = (hash_unit(seed, id_col) < rate - F.floor(rate)).cast("long")
    joined = sized.join(targets.withColumnRenamed(source, key), F.col(source).eqNullSafe(F.col(key)))
    return joined.drop(key).withColumn("copies", F.floor(rate) + extra)


def emit_copies(planned: DataFrame) -> DataFrame:
    """Each row ``copies`` times; the four planning columns go."""
    copies = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    (n,) = unused(planned, "copy_no")
    return planned.where("copies > 0").withColumn(n, copies).drop(n, "size", "source_size", "target", "copies")


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus itself: the columns of ``docs``, each row as often as the mix takes it."""
    return emit_copies(plan_mix(docs, **options))
