"""Connected components by repeated joins; nothing is gathered on the driver but counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tabforge.session import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """``(node, component)`` for every node of ``edges(a, b)``; the component is its smallest node.

    Alternates two steps on the edge list until it is one star per component: every node hangs its larger neighbours on its smallest one (large star), then its
    smaller neighbours (small star). Both keep the components and at most the
    number of edges, and need a number of rounds that grows with the logarithm
    of the nodes. Each round is written to the shared folder, so a lost
    executor costs one round. A hub with very many neighbours costs only a
    partial minimum and a join that AQE can split. Nulls and loops are ignored.
    """
    both = edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    stars = materialize(both.distinct(), "cc-edges")
    while unfinished(stars):
        around = stars.union(stars.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = around.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = around.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.explode(F.array("a", "b")).alias("a"), F.col("m").alias("b"))
        stars = materialize(small.where("a != b").distinct(), "cc-edges")
    roots = stars.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return stars.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def unfinished(stars: DataFrame) -> bool:
    """Whether a node hangs on two others, or is both hung and hung upon."""
    ends = stars.select(F.explode(F.array(
        F.struct(F.col("a").alias("node"), F.col("b").alias("on"), F.lit(0).alias("below")),
        F.struct(F.col("b").alias("node"), F.lit(None).cast("long").alias("on"), F.lit(1).alias("below")),
    )).alias("e")).select("e.*")
    nodes = ends.groupBy("node").agg(F.min("on").alias("lo"), F.max("on").alias("hi"), F.max("below").alias("below"))
    return nodes.where("lo != hi OR (lo IS NOT NULL AND below = 1)").limit(1).count() > 0
