"""Pearson and Spearman correlation tables."""

from __future__ import annotations

import warnings
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabforge.functions.numeric import half_even, not_nan
from tabforge.operators.lookups import align_outer
from tabforge.operators.ranks import running_totals, with_ranks
from tabforge.session import materialize

BAR_WIDTH = 20


def _present(df: DataFrame, columns: list[str]) -> list[str]:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        warnings.warn(f"numeric columns not found, skipped: {sorted(absent)}", stacklevel=3)
    return [c for c in columns if c in df.columns]


_PARTIAL = (
    "pair int, n long, mean_x double, mean_y double, m2_x double, m2_y double, c_xy double, "
    "min_x double, max_x double, min_y double, max_y double"
)


def _partial_moments(places: list[tuple[int, int]]):
    """Central moments of each column pair over one partition, merged batch by batch."""

    def run(batches):
        totals = [None] * len(places)
        for batch in batches:
            columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            known = [~np.isnan(c) for c in columns]
            for p, (i, j) in enumerate(places):
                both = known[i] & known[j]
                n = int(both.sum())
                if n == 0:
                    continue
                x, y = columns[i][both], columns[j][both]
                mx, my = x.mean(), y.mean()
                dx, dy = x - mx, y - my
                new = [n, mx, my, dx @ dx, dy @ dy, dx @ dy, x.min(), x.max(), y.min(), y.max()]
                totals[p] = new if totals[p] is None else _merge(totals[p], new)
        rows = [(p, *t) for p, t in enumerate(totals) if t is not None]
        if rows:
            names = [f.split()[0] for f in _PARTIAL.split(", ")]
            yield pa.RecordBatch.from_pylist(
                [dict(zip(names, map(_plain, r), strict=True)) for r in rows], schema=_ARROW
            )

    return run


_ARROW = pa.schema(
    [("pair", pa.int32()), ("n", pa.int64())]
    + [(f.split()[0], pa.float64()) for f in _PARTIAL.split(", ")[2:]]
)


def _plain(v):
    return v.item() if hasattr(v, "item") else v


def _merge(a: list, b: list) -> list:
    """Moments of the union of two sets of rows."""
    n = a[0] + b[0]
    gx, gy = b[1] - a[1], b[2] - a[2]
    w = a[0] * b[0] / n
    return [
        n,
        a[1] + gx * b[0] / n,
        a[2] + gy * b[0] / n,
        a[3] + b[3] + gx * gx * w,
        a[4] + b[4] + gy * gy * w,
        a[5] + b[5] + gx * gy * w,
        min(a[6], b[6]),
        max(a[7], b[7]),
        min(a[8], b[8]),
        max(a[9], b[9]),
    ]


def correlations(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Unrounded pairwise-complete Pearson r of each pair ``(feature_a, feature_b, r)``.

    One pass: every task reduces its rows to one line of moments per pair (a
    JVM aggregation of the same m*(m+1)/2 pairs is several times slower), and
    the lines are combined around the common means. NULL for a side that is
    constant over the pair's complete rows.
    """
    columns = sorted({c for p in pairs for c in p})
    data = df.select(*[not_nan(c).alias(c) for c in columns])
    places = [(columns.index(a), columns.index(b)) for a, b in pairs]
    partial = data.mapInArrow(_partial_moments(places), _PARTIAL)
    own = Window.partitionBy("pair")
    n = F.col("n").cast("double")
    centred = (
        partial.withColumn("all_n", F.sum(n).over(own))
        .withColumn("gx", F.col("mean_x") - F.sum(F.col("mean_x") * n).over(own) / F.col("all_n"))
        .withColumn("gy", F.col("mean_y") - F.sum(F.col("mean_y") * n).over(own) / F.col("all_n"))
    )
    spread_x = F.sum(F.col("m2_x") + n * F.col("gx") * F.col("gx"))
    spread_y = F.sum(F.col("m2_y") + n * F.col("gy") * F.col("gy"))
    joint = F.sum(F.col("c_xy") + n * F.col("gx") * F.col("gy"))
    varies = (F.min("min_x") < F.max("max_x")) & (F.min("min_y") < F.max("max_y"))
    r = F.when(varies, F.try_divide(joint, F.sqrt(spread_x) * F.sqrt(spread_y)))
    found = centred.groupBy("pair").agg(r.alias("r"))
    names = F.array(*[F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in pairs])
    # Pairs without a single complete row have no line of moments: they stay, with NULL.
    wanted = df.sparkSession.range(len(pairs)).select(F.col("id").cast("int").alias("pair"))
    at = F.get(names, F.col("pair"))
    return wanted.join(found, "pair", "left").select(at["a"].alias("feature_a"), at["b"].alias("feature_b"), "r")


def _mirror(upper: DataFrame) -> DataFrame:
    """Both triangles from one triangle with its diagonal."""
    a, b, r = F.col("feature_a"), F.col("feature_b"), F.col("r")
    same = F.array(F.struct(a.alias("feature_a"), b.alias("feature_b"), r.alias("r")))
    both = F.concat(same, F.array(F.struct(b.alias("feature_a"), a.alias("feature_b"), r.alias("r"))))
    return upper.select(F.explode(F.when(a == b, same).otherwise(both)).alias("p")).select("p.*")


def corr_matrix(df: DataFrame, columns: list[str], target: str, digits: int = 3) -> DataFrame:
    """Pairwise-complete Pearson matrix of the columns and the target in long form."""
    cols = _present(df, [*columns, target])
    pairs = [(c, c) for c in cols] + list(combinations(cols, 2))
    return _mirror(correlations(df, pairs)).withColumn("r", half_even("r", digits))


def _spearman(df: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """Pearson over average ranks; a pair with missing values is ranked on its complete rows."""
    columns = sorted({c for p in pairs for c in p})
    data = df.select(*[not_nan(c).alias(c) for c in columns])
    holes = data.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns]).first()
    full = [p for p in pairs if holes[p[0]] == holes[p[1]] == 0]
    parts = []
    if full:
        parts.append(correlations(with_ranks(data, sorted({c for p in full for c in p})), full))
    if len(full) < len(pairs):
        parts.append(_spearman_of_complete_rows(data, [p for p in pairs if p not in full]))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def _spearman_of_complete_rows(data: DataFrame, pairs: list[tuple[str, str]]) -> DataFrame:
    """All pairs in one pass over the rows, each of which stays one row.

    A value has one rank per partner of its column: its place among the rows
    that know both. One count by (column, value) gives all of them, and a row
    takes them from a table per column.
    """
    columns = sorted({c for p in pairs for c in p})
    partners = {c: sorted({d for p in pairs if c in p for d in p if d != c or p == (c, c)}) for c in columns}
    place = {c: i for i, c in enumerate(columns)}
    numbers = data.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    known = F.array(*[F.col(f"v{i}").isNotNull() for i in range(len(columns))])
    entry = [F.when(F.col(f"v{i}").isNotNull(), F.struct(F.lit(i).alias("column"), F.col(f"v{i}").alias("value"), known.alias("known"))) for i in range(len(columns))]
    long = numbers.select(F.explode(F.array_compact(F.array(*entry))).alias("e")).select("e.*")
    counts = [F.count_if(F.get("known", F.lit(i))).alias(f"n{i}") for i in range(len(columns))]
    cells = materialize(long.groupBy("column", "value").agg(*counts), "value-counts")
    upto = running_totals(cells, "column", "value", {f"upto{i}": f"n{i}" for i in range(len(columns))})
    ranks = [(F.col(f"upto{i}") - (F.col(f"n{i}") - 1) / 2).alias(f"r{i}") for i in range(len(columns))]
    tables = materialize(upto.select("value", *ranks, "column"), "ranks", partition_by=["column"])
    sizes = {r["column"]: r["n"] for r in cells.groupBy("column").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = numbers
    # The column with most values first: a table that has to be shuffled meets rows without ranks.
    for i in sorted(place.values(), key=lambda i: -sizes.get(i, 0)):
        mine = [F.col(f"r{place[d]}").alias(f"r{i}_{place[d]}") for d in partners[columns[i]]]
        rows = rows.join(tables.where(F.col("column") == i).select(F.col("value").alias("_v"), *mine), F.col(f"v{i}") == F.col("_v"), "left").drop("_v", f"v{i}")
    sides = [(f"r{place[a]}_{place[b]}", f"r{place[b]}_{place[a]}") for a, b in pairs]
    names = [F.struct(F.lit(x).alias("_x"), F.lit(y).alias("_y"), F.lit(a).alias("_a"), F.lit(b).alias("_b")) for (x, y), (a, b) in zip(sides, pairs, strict=True)]
    listed = data.sparkSession.range(1).select(F.explode(F.array(*names)).alias("e")).select("e.*")
    found = correlations(rows, sides)
    both = (F.col("_x") == F.col("feature_a")) & (F.col("_y") == F.col("feature_b"))
    return listed.join(found, both).select(F.col("_a").alias("feature_a"), F.col("_b").alias("feature_b"), "r")


def corr_spearman(df: DataFrame, columns: list[str], target: str, digits: int = 3) -> DataFrame:
    cols = _present(df, [*columns, target])
    pairs = [(c, c) for c in cols] + list(combinations(cols, 2))
    return _mirror(_spearman(df, pairs)).withColumn("r", half_even("r", digits))


def _strength(c: str = "r") -> Column:
    return F.abs(F.col(c)).desc_nulls_last()


def corr_with_target(
    df: DataFrame, columns: list[str], target: str, digits: int = 3, method: str = "pearson"
) -> DataFrame:
    """Features ordered by the size of their correlation with the target."""
    pairs = [(c, target) for c in _present(df, columns)]
    rows = correlations(df, pairs) if method == "pearson" else _spearman(df, pairs)
    return rows.select(F.col("feature_a").alias("feature"), half_even("r", digits).alias("r")).orderBy(
        _strength(), "feature"
    )


def corr_bar(ranked: DataFrame) -> DataFrame:
    """A 20-cell text bar per correlation."""
    filled = half_even(F.abs("r") * BAR_WIDTH).cast("int")
    sign = F.when(F.col("r") >= 0, "+").otherwise("-")
    bar = F.concat(sign, F.repeat(F.lit("█"), filled), F.repeat(F.lit("░"), F.lit(BAR_WIDTH) - filled))
    return ranked.withColumn("bar", F.when(F.col("r").isNotNull(), bar))


def corr_json(matrix: DataFrame, columns: list[str]) -> DataFrame:
    """The matrix as one JSON object with ``columns``, ``index`` and ``values``."""
    order = F.array(*map(F.lit, columns))
    place_a, place_b = F.array_position(order, F.col("feature_a")), F.array_position(order, F.col("feature_b"))
    line = F.transform(F.array_sort(F.collect_list(F.struct(place_b.alias("i"), "r"))), lambda s: s["r"])
    lines = matrix.groupBy("feature_a").agg(line.alias("row"))
    values = F.transform(F.array_sort(F.collect_list(F.struct(place_a.alias("i"), "row"))), lambda s: s["row"])
    body = F.struct(order.alias("columns"), order.alias("index"), F.col("values"))
    options = {"ignoreNullFields": "false"}
    return lines.agg(values.alias("values")).select(F.to_json(body, options).alias("json"))


def high_corr_pairs(df: DataFrame, columns: list[str], threshold: float = 0.7) -> DataFrame:
    """Feature pairs (later column first) whose rounded |r| exceeds the threshold."""
    cols = _present(df, columns)
    pairs = [(b, a) for a, b in combinations(cols, 2)]
    rows = correlations(df, pairs).withColumn("r", half_even("r", 3))
    return rows.where(F.abs("r") > threshold).orderBy(_strength(), "feature_a", "feature_b")


def method_delta(df: DataFrame, columns: list[str], target: str) -> DataFrame:
    """Pearson next to Spearman for each feature, and their difference."""
    pearson = corr_with_target(df, columns, target).withColumnRenamed("r", "pearson")
    spearman = corr_with_target(df, columns, target, method="spearman").withColumnRenamed("r", "spearman")
    return (
        align_outer(pearson, spearman, "feature")
        .withColumn("delta", half_even(F.col("spearman") - F.col("pearson"), 3))
        .orderBy(_strength("pearson"), "feature")
    )
