"""Exact grouped quantiles by certified brackets, bounded for groups of any size.

Spark's ``percentile`` keeps every distinct value of a group in one map in one
task, so a group with a third of a large table does not fit.  Here the first
scan gives each group's count, range and a mergeable rank sketch, and the sketch
a narrow bracket around each wanted order statistic.  The second scan counts
all rows: one number for what lies between brackets, one per value inside them,
so every rank is known exactly.  A bracket that turns out to miss its rank, or
one that may hold many rows and was counted in bins, leaves a smaller one for
another scan. Only counts are shuffled, combined on the map side.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import not_nan, sample_skewness
from tabforge.session import materialize, setting

DEFAULT_ACCURACY = 10_000
BINS = 4096
LISTED = 1_000_000  # a bracket with no more rows is counted value by value
SKETCH = 1024  # size of the rank sketch, which takes at most about 30 KB
MARGIN = 0.01  # share of the rows on each side of a bracket; the sketch's ranks are wrong by 0.0045 at a confidence of 99 %
SKETCHES = 4096  # sketches that a task keeps side by side before it sorts its rows by group
_LARGEST = 1.7976931348623157e308  # infinite values count as this while they are counted

_STATS: dict[str, Callable[[Column], Column]] = {
    "mean": F.avg,
    "std": F.stddev_samp,
    "std_pop": F.stddev_pop,
    "min": F.min,
    "max": F.max,
    "sum": F.sum,
    "skew": sample_skewness,
}


def group_stats(
    df: DataFrame,
    keys: list[str],
    value: str | Column,
    quantiles: dict[str, float] | None = None,
    stats: tuple[str, ...] = ("mean",),
    keep: Callable[[DataFrame], DataFrame] | None = None,
    scalars: dict[str, Callable[[DataFrame], Column]] | None = None,
    accuracy: int = DEFAULT_ACCURACY,
    approximate: bool = False,
    bins: int = BINS,
    listed: int = LISTED,
) -> DataFrame:
    """Per-group ``count``, ``stats`` and interpolated ``quantiles`` of ``value``.

    ``keep`` narrows the table of groups between the passes (top-n, non-null
    keys), so that quantiles are only worked out for the groups that are kept.
    ``approximate=True`` returns a sketch's answer after one pass. ``bins`` and
    ``listed`` set the size of what a task of the exact way may hold.
    ``scalars`` adds columns worked out over the stored table of all groups
    (count and ``stats``), such as the overall mean.
    """
    if not keys:
        raise ValueError("group_stats needs a key; use column_stats for whole columns")
    quantiles = quantiles or {}
    probs = list(quantiles.values())
    data = df.select(*keys, not_nan(value).alias("_x"))
    x = F.col("_x")

    aggs = [F.count(x).alias("count"), *[_STATS[s](x).alias(s) for s in stats]]
    if probs and approximate:
        aggs.append(_sketch(probs, accuracy).alias("_q"))
    elif probs:
        aggs += [F.min(x).alias("_min"), F.max(x).alias("_max"), F.kll_sketch_agg_double(x, SKETCH).alias("_sketch")]
    groups = data.groupBy(*keys).agg(*aggs)
    if probs and not approximate:
        groups = groups.select(*keys, "count", *stats, *brackets(probs, listed), F.monotonically_increasing_id().alias("_g"))
    with setting(df.sparkSession, "spark.sql.objectHashAggregate.sortBased.fallbackThreshold", SKETCHES):
        stored = materialize(groups, "group-sketch")
    base = keep(stored) if keep else stored
    plain = ["count", *stats]
    extra = {name: make(stored) for name, make in (scalars or {}).items()}
    if not probs:
        return base.withColumns(extra)
    if approximate:
        sketched = [F.col("_q")[i].alias(name) for i, name in enumerate(quantiles)]
        return base.select(*keys, *plain, *sketched).withColumns(extra)

    found = order_statistics(data, base, keys, probs, bins, listed)
    picks = []
    for i, (name, p) in enumerate(quantiles.items()):
        position = F.lit(p) * (F.col("_n") - 1)
        picks.append(between(F.col(f"_lo{2 * i}"), F.col(f"_lo{2 * i + 1}"), position - F.floor(position)).alias(name))
    joined = base.join(found.select("_g", *picks), "_g", "left")
    return joined.select(*keys, *plain, *quantiles).withColumns(extra)


def brackets(probs: list[float], listed: int) -> list[Column]:
    """For each probability ``_lo``, ``_hi`` and ``_many`` (more than ``listed`` rows may lie between), of a group's count, range and sketch."""
    columns = []
    few = f"count * {MARGIN} < 4"  # a rank is then too wide a share of the group
    for i, p in enumerate(probs):
        low, high = max(0.0, p - MARGIN), min(1.0, p + MARGIN)
        for side, end, rank in (("lo", "_min", low), ("hi", "_max", high)):
            at = f"CASE WHEN {rank} IN (0.0, 1.0) OR {few} THEN {end} WHEN count > 0 THEN kll_sketch_get_quantile_double(_sketch, {rank}D) END"
            columns.append(F.expr(f"greatest(least({at}, {_LARGEST!r}D), -{_LARGEST!r}D) AS _{side}{i}"))
        columns.append(F.expr(f"if({few}, count, count * {high - low}) > {listed} AS _many{i}"))
    return columns


def order_statistics(data: DataFrame, groups: DataFrame, keys: list[str], probs: list[float], bins: int, listed: int) -> DataFrame:
    """``(_g, _n, _lo0, _lo1, ..)``: per group the values below and above the position of each probability.

    ``data`` has the keys and ``_x``; ``groups`` has the keys, a number ``_g``,
    ``count`` and the brackets. Each scan turns a bracket into the cell that
    holds its rank, so it ends with cells of one value whatever the sketch said.
    """
    named = [f"_k{j}" for j in range(len(keys))]
    sides = [f"_{side}{i}" for i in range(len(probs)) for side in ("lo", "hi", "many")]
    known = groups.where("count > 0").select(*[F.col(k).alias(n) for k, n in zip(keys, named, strict=True)], F.col("count").alias("_n"), "_g", *sides)
    same = _all([F.col(k).eqNullSafe(F.col(n)) for k, n in zip(keys, named, strict=True)])
    data = data.where("_x IS NOT NULL").withColumn("_x", F.expr(f"greatest(least(_x, {_LARGEST!r}D), -{_LARGEST!r}D)"))
    ranks = [f"{f}({p!r}D * (_n - 1))" for p in probs for f in ("floor", "ceil")]
    wide = " OR ".join(f"_lo{r} < _hi{r}" for r in range(len(ranks)))
    found = materialize(counted(data.join(known, same), len(probs), ranks, bins, listed), "order-statistics")
    done = found.where(f"NOT ({wide})")
    while not (open_ := found.where(wide)).isEmpty():
        again = data.join(known.select(*named, "_g"), same).join(open_, "_g")
        found = materialize(counted(again, len(ranks), ranks, bins, listed), "order-statistics")
        done = done.union(found.where(f"NOT ({wide})"))
    infinite = "CASE WHEN {0} = {1} THEN double('infinity') WHEN {0} = -{1} THEN double('-infinity') ELSE {0} END AS {0}"
    return done.selectExpr("_g", "_n", *[infinite.format(f"_lo{r}", f"{_LARGEST!r}D") for r in range(len(ranks))])


def counted(rows: DataFrame, width: int, ranks: list[str], bins: int, listed: int) -> DataFrame:
    """One scan: per group the range ``_lo``, ``_hi`` of the cell that holds each rank, and ``_many``, whether it has more than ``listed`` rows.

    The bounds of a row's ``width`` brackets cut the line into points and open
    stretches, numbered from below. A stretch inside a bracket is cut further,
    into its values or into bins; one outside is a single cell.
    """
    ends = [f"_{side}{b}" for b in range(width) for side in ("lo", "hi")]
    cell = " + ".join(f"int(_x > {e}) + int(_x >= {e})" for e in ends)
    slots = []
    for b in range(width):
        low, high = f"_lo{b}", f"_hi{b}"
        part = f"double(least(floor((_x / 2 - {low} / 2) / ({high} / 2 - {low} / 2) * {bins}), {bins - 1}))"
        slots.append(f"WHEN _x > {low} AND _x < {high} THEN if(_many{b}, {part}, _x)")
    cells = (
        rows.selectExpr("_g", "_n", "_x", f"{cell} AS _cell", f"CASE {' '.join(slots)} END AS _slot")
        .groupBy("_g", "_n", "_cell", "_slot")
        .agg(F.expr("min(_x) AS _least"), F.expr("max(_x) AS _most"), F.expr("count(1) AS _c"))
        .selectExpr("*", "sum(_c) OVER (PARTITION BY _g, _n ORDER BY _cell, _slot ROWS UNBOUNDED PRECEDING) AS _upto")
    )
    held = []
    for r, rank in enumerate(ranks):
        holds = f"_upto > {rank} AND _upto - _c <= {rank}"
        held += [f"max(_least) FILTER (WHERE {holds}) AS _lo{r}", f"max(_most) FILTER (WHERE {holds}) AS _hi{r}", f"max(_c) FILTER (WHERE {holds}) > {listed} AS _many{r}"]
    return cells.groupBy("_g", "_n").agg(*[F.expr(h) for h in held])


def between(low: Column, high: Column, frac: Column) -> Column:
    """Linear interpolation that starts from the nearer end, so that no last digit is lost."""
    gap = high - low
    return (
        F.when(low == high, low)  # also for infinite values
        .when(frac == 0.5, (low + high) / 2)
        .when(frac > 0.5, high - gap * (F.lit(1.0) - frac))
        .otherwise(low + gap * frac)
    )


def overall_mean(where: Column | None = None) -> Callable[[DataFrame], Column]:
    """For ``scalars``: the mean over all rows, from the groups' sums and counts."""

    def make(groups: DataFrame) -> Column:
        rows = groups if where is None else groups.where(where)
        return rows.agg(F.try_divide(F.sum("sum"), F.sum("count").cast("double"))).scalar()

    return make


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out


def _sketch(probs: list[float], accuracy: int) -> Column:
    return F.percentile_approx("_x", F.array(*map(F.lit, probs)), F.lit(accuracy))


def column_stats(
    df: DataFrame,
    columns: list[str],
    quantiles: dict[str, float] | None = None,
    stats: tuple[str, ...] = ("mean",),
    **options,
) -> DataFrame:
    """``group_stats`` of several numeric columns in the same two passes."""
    long = df.select(*[F.col(c).cast("double").alias(c) for c in columns]).unpivot([], columns, "column", "_v")
    return group_stats(long, ["column"], "_v", quantiles, stats, **options)
