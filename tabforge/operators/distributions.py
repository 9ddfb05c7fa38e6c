"""Histograms, density estimates, box-plot and violin data."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import half_even, not_nan
from tabforge.operators.quantiles import group_stats
from tabforge.session import materialize

_SCALES = {"raw": lambda x: x, "sqrt": F.sqrt, "log1p": F.log1p}


def histogram(df: DataFrame, column: str, bins: int = 80, scales: tuple[str, ...] = ("raw",)) -> DataFrame:
    """Equal-width bins over the data range, last bin closed, per scale of the column.

    A constant column has one bin of zero width and no density.
    """
    x = not_nan(column)
    # raw values first; the scaled copies exist only where the scale is defined
    data = df.select(*[F.when(x >= 0, _SCALES[s](x)).alias(s) if s != "raw" else x.alias(s) for s in scales])
    long = data.unpivot([], list(scales), "scale", "x").where(F.col("x").isNotNull())
    ranges = materialize(
        long.groupBy(F.col("scale").alias("_s")).agg(
            F.min("x").alias("lo"), F.max("x").alias("hi"), F.count("x").alias("n")
        ),
        "ranges",
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    place = F.least(F.floor(F.try_divide(F.col("x") - F.col("lo"), F.col("w"))), F.lit(bins - 1))
    binned = (
        long.join(ranges.withColumn("w", width), F.col("scale") == F.col("_s"))
        .withColumn("bin", F.coalesce(place, F.lit(0)).cast("int"))
        .groupBy("scale", "bin", "lo", "w", "n")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return binned.select(
        "scale",
        "bin",
        half_even(F.col("lo") + F.col("bin") * F.col("w"), 4).alias("left_edge"),
        half_even(F.col("lo") + (F.col("bin") + 1) * F.col("w"), 4).alias("right_edge"),
        "count",
        half_even(F.try_divide(F.col("count"), F.col("n") * F.col("w")), 8).alias("density"),
    ).orderBy("scale", "bin")


def kde(df: DataFrame, column: str, points: int = 100, group: str | None = None, digits: int = 10) -> DataFrame:
    """Gaussian density (Scott bandwidth) on an even grid over each group's data range.

    Every value contributes to every grid point. One aggregate has a sum per
    grid point, so a task keeps ``points`` partial sums per group and only those
    are shuffled. A group without spread has no density.
    """
    x = not_nan(column)
    if group:
        data = df.select(F.col(group).cast("string").alias("g"), x.alias("x"))
    else:
        data = df.select(x.alias(column)).unpivot([], [column], "g", "x")
    data = data.where(F.col("x").isNotNull() & F.col("g").isNotNull())
    n = F.count("x").cast("double")
    shape = materialize(
        data.groupBy(F.col("g").alias("_g")).agg(
            n.alias("n"),
            F.min("x").alias("lo"),
            F.max("x").alias("hi"),
            (F.stddev_samp("x") * F.pow(n, F.lit(-0.2))).alias("h"),
        ),
        "kde-shape",
    )
    rows = data.join(shape.where("h > 0"), F.col("g") == F.col("_g"))

    def at(i: Column) -> Column:
        return F.col("lo") + i * (F.col("hi") - F.col("lo")) / F.lit(float(points - 1))

    def share(i: int) -> Column:
        z = (F.col("x") - at(F.lit(i))) / F.col("h")
        return F.sum(F.exp(F.lit(-0.5) * z * z)).alias(f"s{i}")

    fixed, cells = ["g", "n", "lo", "hi", "h"], [f"s{i}" for i in range(points)]
    sums = rows.groupBy(*fixed).agg(*[share(i) for i in range(points)]).unpivot(fixed, cells, "cell", "s")
    sums = sums.withColumn("i", F.substring("cell", 2, 9).cast("int"))
    density = F.col("s") / (F.col("n") * F.col("h") * F.lit(math.sqrt(2 * math.pi)))
    out = sums.select(
        F.col("g").alias(group or "series"),
        "i",
        half_even(at(F.col("i")), 4).alias("x"),
        half_even(density, digits).alias("density"),
    )
    return out.orderBy(group or "series", "i")


def boxplot_stats(df: DataFrame, group: str, target: str) -> DataFrame:
    """Quartiles, whiskers (extreme values within 1.5 IQR of the box) and outlier count per group."""
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    box = materialize(group_stats(df, [group], target, quartiles, (), keep=lambda g: g.dropna(subset=[group])), "boxes")
    iqr = F.col("q3") - F.col("q1")
    fences = box.select(
        F.col(group).alias("_g"),
        "q1",
        "median",
        "q3",
        (F.col("q1") - 1.5 * iqr).alias("_low"),
        (F.col("q3") + 1.5 * iqr).alias("_high"),
    )
    x = F.col("_x")
    within = x.between(F.col("_low"), F.col("_high"))
    rows = df.select(group, not_nan(target).alias("_x")).join(fences, F.col(group) == F.col("_g"))
    return (
        rows.groupBy(group, "q1", "median", "q3")
        .agg(
            F.min(F.when(within, x)).alias("whisker_low"),
            F.max(F.when(within, x)).alias("whisker_high"),
            F.count_if(~within).alias("outliers"),
        )
        .orderBy(F.desc("median"), group)
        .select(
            group,
            *[half_even(c, 2).alias(c) for c in ("q1", "median", "q3", "whisker_low", "whisker_high")],
            "outliers",
        )
    )


def violin(df: DataFrame, group: str, target: str, points: int = 50) -> DataFrame:
    """Quartiles of each group next to its density curve, cut at the data range."""
    quartiles = {"q1": 0.25, "median": 0.5, "q3": 0.75}
    box = group_stats(df, [group], target, quartiles, (), keep=lambda g: g.dropna(subset=[group]))
    curve = kde(df, target, points, group)
    return curve.join(box.select(group, *[half_even(c, 2).alias(c) for c in quartiles]), group)


