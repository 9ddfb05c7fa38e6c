"""Grouped price statistics and KPIs."""

from __future__ import annotations

import warnings

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import half_even, pct_over
from tabforge.operators.quantiles import group_stats, overall_mean
from tabforge.session import materialize

QUARTILES = {"median": 0.5, "p25": 0.25, "p75": 0.75}
MEDIAN = {"median": 0.5}

# Right-closed booking windows and their labels.
WINDOW_EDGES = [0, 7, 14, 30, 60, 90, 180, 365, 9999]
WINDOW_LABELS = ["0-7", "8-14", "15-30", "31-60", "61-90", "91-180", "181-365", "365+"]

# Month names.
MONTHS = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]


_OVERALL = {"_overall": overall_mean()}


def rounded(names: list[str] | tuple[str, ...], digits: int) -> list[Column]:
    return [F.col(n) if n == "count" else half_even(n, digits).alias(n) for n in names]


def _known(keys: list[str]):
    """Grouping drops rows whose key is missing."""
    return lambda groups: groups.dropna(subset=keys)


def summary_by_group(df: DataFrame, group: str, target: str, **options) -> DataFrame:
    """Count, mean, median, std, quartiles and range per group, and % over the overall mean.

    The percentage starts from the rounded group mean.
    """
    stats = group_stats(
        df, [group], target, QUARTILES, ("mean", "std", "min", "max", "sum"), keep=_known([group]), scalars=_OVERALL, **options
    )
    names = ["count", "mean", "median", "std", "p25", "p75", "min", "max"]
    return (
        stats.select(group, *rounded(names, 2), "_overall")
        .withColumn("pct_vs_avg", pct_over(F.col("mean"), F.col("_overall")))
        .drop("_overall")
        .orderBy(F.desc("mean"), group)
    )


def summary_grouping_sets(df: DataFrame, groups: list[str], target: str, **options) -> DataFrame:
    """``summary_by_group`` for several group columns in one long table.

    All sets share the two passes of the quantile operator. Columns that do not
    exist are skipped with a warning.
    """
    absent = [g for g in groups if g not in df.columns]
    if absent:
        warnings.warn(f"columns not found, skipped: {absent}", stacklevel=2)
    present = [g for g in groups if g in df.columns]
    keys = [F.col(g).cast("string").alias(g) for g in present]
    long = df.select(target, *keys).unpivot([target], present, "group_col", "group_value")
    stats = group_stats(
        long,
        ["group_col", "group_value"],
        target,
        QUARTILES,
        ("mean", "std", "min", "max", "sum"),
        keep=_known(["group_value"]),
        scalars={"_overall": overall_mean(F.col("group_col") == present[0])},
        **options,
    )
    names = ["count", "mean", "median", "std", "p25", "p75", "min", "max"]
    return (
        stats.select("group_col", "group_value", *rounded(names, 2), "_overall")
        .withColumn("pct_vs_avg", pct_over(F.col("mean"), F.col("_overall")))
        .drop("_overall")
        .orderBy("group_col", F.desc("mean"), "group_value")
    )


def kpi_by_group(df: DataFrame, group: str, target: str) -> DataFrame:
    stats = group_stats(df, [group], target, MEDIAN, ("mean", "std", "sum"), keep=_known([group]), scalars=_OVERALL)
    return (
        stats.select(group, *rounded(["count", "mean", "median", "std"], 2), "_overall")
        .withColumn("pct_vs_avg", pct_over(F.col("mean"), F.col("_overall")))
        .drop("_overall")
        .orderBy(F.desc("mean"), group)
    )


def _route_label(a: str, b: str) -> Column:
    return F.concat(F.col(a), F.lit(" → "), F.col(b)).alias("route")


def top_pairs_by_count(df: DataFrame, a: str, b: str, target: str, n: int = 10) -> DataFrame:
    """The ``n`` most frequent pairs; medians are worked out for those only."""

    def top(groups: DataFrame) -> DataFrame:
        return _known([a, b])(groups).orderBy(F.desc("count"), a, b).limit(n)

    stats = group_stats(df, [a, b], target, MEDIAN, ("mean",), keep=top)
    return stats.select(
        a,
        b,
        F.col("count").alias("flight_count"),
        half_even("mean", 2).alias("mean_fare"),
        half_even("median", 2).alias("median_fare"),
        _route_label(a, b),
    ).orderBy(F.desc("flight_count"), a, b)


def top_pairs_by_mean(df: DataFrame, a: str, b: str, target: str, n: int = 5) -> DataFrame:
    def top(groups: DataFrame) -> DataFrame:
        return _known([a, b])(groups).orderBy(half_even("mean", 2).desc(), a, b).limit(n)

    stats = group_stats(df, [a, b], target, MEDIAN, ("mean", "std", "max"), keep=top)
    return stats.select(a, b, *rounded(["count", "mean", "median", "std", "max"], 2), _route_label(a, b)).orderBy(
        F.desc("mean"), a, b
    )


def group_vs_baseline(df: DataFrame, group: str, target: str, baseline: str) -> DataFrame:
    """Group statistics and % over the baseline group's rounded mean, or over the overall mean without one."""

    def base_mean(groups: DataFrame) -> Column:
        own = groups.where(F.col(group) == baseline).agg(half_even(F.max("mean"), 2)).scalar()
        return F.coalesce(own, overall_mean()(groups))

    stats = group_stats(
        df,
        [group],
        target,
        MEDIAN,
        ("mean", "std", "min", "max", "sum"),
        keep=_known([group]),
        scalars={"_base": base_mean},
    )
    names = ["count", "mean", "median", "std", "min", "max"]
    return (
        stats.select(group, *rounded(names, 2), "_base")
        .withColumn("pct_vs_regular", pct_over(F.col("mean"), F.col("_base")))
        .drop("_base")
        .orderBy(F.desc("mean"), group)
    )


def pricing(df: DataFrame, keys: list[str], target: str, stats: tuple[str, ...] = ("mean", "std")) -> DataFrame:
    """Typical price per group, ordered by the unrounded median, rounded to whole units."""
    order = [F.desc("_median"), *keys]
    return pricing_exact(df, keys, target, stats).orderBy(*order).drop("_median")


def pricing_exact(df: DataFrame, keys: list[str], target: str, stats: tuple[str, ...]) -> DataFrame:
    """``pricing`` unordered, with the unrounded median kept as ``_median``."""
    rows = group_stats(df, keys, target, MEDIAN, stats, keep=_known(keys))
    return rows.select(
        *keys,
        half_even("median").alias("median_fare"),
        *[half_even(s).alias(f"{s}_fare") for s in stats],
        "count",
        F.col("median").alias("_median"),
    )


def pricing_fixed_order(df: DataFrame, group: str, target: str, order: list[str]) -> DataFrame:
    """``pricing`` in a given display order; groups outside the list lose their label and come last."""
    rows = pricing_exact(df, [group], target, ("mean", "std"))
    position = F.array_position(F.array(*map(F.lit, order)), F.col(group)).cast("int")
    return (
        rows.withColumn("sort_key", F.when(position > 0, position).otherwise(len(order) + 1))
        .withColumn(group, F.when(F.col("sort_key") <= len(order), F.col(group)))
        .select("sort_key", group, "median_fare", "mean_fare", "std_fare", "count")
        .orderBy("sort_key")
    )


def top_and_bottom(df: DataFrame, keys: list[str], target: str, n: int = 10) -> DataFrame:
    """First and last ``n`` groups of the order by median; they may overlap."""
    rows = materialize(pricing_exact(df, keys, target, ()), "group-stats")
    top = rows.orderBy(F.desc("_median"), *keys).limit(n).withColumn("side", F.lit("top"))
    bottom = rows.orderBy("_median", *[F.desc(k) for k in keys]).limit(n).withColumn("side", F.lit("bottom"))
    return top.unionByName(bottom).select("side", *keys, "median_fare", "count")


def booking_window(days: str | Column) -> Column:
    """Label of the right-closed window that holds ``days``; NULL outside all of them."""
    d = F.col(days) if isinstance(days, str) else days
    label = F.when(d <= WINDOW_EDGES[0], F.lit(None).cast("string"))
    for edge, name in zip(WINDOW_EDGES[1:], WINDOW_LABELS, strict=True):
        label = label.when(d <= edge, name)
    return label


def bucket_pricing(df: DataFrame, days: str, target: str) -> DataFrame:
    rows = df.withColumn("booking_window", booking_window(days))
    return _by_window(pricing_exact(rows, ["booking_window"], target, ()).drop("_median"))


def bucket_quartiles(df: DataFrame, days: str, target: str) -> DataFrame:
    rows = df.withColumn("booking_window", booking_window(days))
    stats = group_stats(
        rows, ["booking_window"], target, {"median": 0.5, "q25": 0.25, "q75": 0.75}, (), keep=_known(["booking_window"])
    )
    return _by_window(stats.select("booking_window", *rounded(["median", "q25", "q75"], 4)))


def _by_window(rows: DataFrame) -> DataFrame:
    return rows.orderBy(F.array_position(F.array(*map(F.lit, WINDOW_LABELS)), F.col("booking_window")))


def monthly_trend(df: DataFrame, month: str, target: str) -> DataFrame:
    """Mean, median and std per month with its name and a band of one std."""
    stats = group_stats(df, [month], target, MEDIAN, ("mean", "std"), keep=_known([month]))
    name = F.element_at(F.array(*map(F.lit, MONTHS)), F.col(month))
    return stats.select(
        month,
        name.alias("month_name"),
        *rounded(["mean", "median", "std"], 2),
        half_even(F.col("mean") - F.col("std"), 2).alias("band_low"),
        half_even(F.col("mean") + F.col("std"), 2).alias("band_high"),
    ).orderBy(month)


def season_stats(df: DataFrame, season: str, target: str) -> DataFrame:
    stats = group_stats(df, [season], target, MEDIAN, ("mean", "std"), keep=_known([season]))
    return stats.orderBy(F.desc("mean"), season).select(season, *rounded(["mean", "median", "std"], 2))


def season_premium(df: DataFrame, season: str, target: str, order: list[str], baseline: str) -> DataFrame:
    """Median per season of a fixed list (NULL where a season is absent) and % over the baseline."""
    from tabforge.operators.lookups import reindex

    stats = materialize(group_stats(df, [season], target, MEDIAN, (), keep=_known([season])), "group-stats")
    rows = reindex(stats.select(season, "median"), season, order)
    base = stats.where(F.col(season) == baseline).agg(F.max("median")).scalar()
    return rows.select(
        "position",
        season,
        half_even("median", 2).alias("median_fare"),
        pct_over(F.col("median"), base).alias("pct_over_baseline"),
    ).orderBy("position")


def pair_pivot(df: DataFrame, rows: str, cols: str, values: list[str], target: str) -> DataFrame:
    """Median of ``target`` per pair as a matrix; NULL where a pair has no rows."""
    stats = group_stats(df, [rows, cols], target, MEDIAN, (), keep=_known([rows, cols]))
    return (
        stats.groupBy(rows).pivot(cols, values).agg(F.first("median")).select(rows, *rounded(values, 2)).orderBy(rows)
    )


def component_summary(df: DataFrame, columns: list[str]) -> DataFrame:
    """Mean, median and skew of each price component."""
    from tabforge.operators.quantiles import column_stats

    stats = column_stats(df, columns, MEDIAN, ("mean", "skew"))
    return stats.select("column", *rounded(["mean", "median"], 2), half_even("skew", 3).alias("skew"))


def premium_ratios(
    df: DataFrame, carrier: str, season: str, travel_class: str, target: str, season_order: list[str], baseline: str
) -> DataFrame:
    """Report ratios: dearest and cheapest group, season premium over the baseline, class multiple."""
    stats = _medians(df, [carrier, season, travel_class], target)
    return ratios_from(stats, carrier, season, travel_class, season_order, baseline)


def _medians(df: DataFrame, groups: list[str], target: str) -> DataFrame:
    keys = [F.col(g).cast("string").alias(g) for g in groups]
    long = df.select(target, *keys).unpivot([target], groups, "group_col", "group_value")
    return group_stats(long, ["group_col", "group_value"], target, MEDIAN, (), keep=_known(["group_value"]))


def ratios_from(
    stats: DataFrame, carrier: str, season: str, travel_class: str, season_order: list[str], baseline: str
) -> DataFrame:
    """One row from the group medians; ratios use whole-unit medians, as the report shows them."""
    m = half_even("median")
    shown = stats.select("group_col", "group_value", "median", m.alias("m"))

    def of(group: str, wanted: Column) -> Column:
        return F.when(F.col("group_col") == group, wanted)

    def first_key(group: str, descending: bool) -> Column:
        """Name and shown median of the first group by unrounded median, ties by name."""
        rank = -F.col("median") if descending else F.col("median")
        tie = F.struct(rank.alias("r"), F.col("group_value").alias("g"), "m")
        return F.min(of(group, tie))

    def last_key(group: str) -> Column:
        """Last group of the order (median descending, name ascending)."""
        return F.max(of(group, F.struct((-F.col("median")).alias("r"), F.col("group_value").alias("g"), "m")))

    place = F.array_position(F.array(*map(F.lit, season_order)), F.col("group_value"))
    peak = F.min(F.when((F.col("group_col") == season) & (place > 0), F.struct(place.alias("r"), F.col("group_value").alias("g"), "m")))
    base = F.max(F.when((F.col("group_col") == season) & (F.col("group_value") == baseline), F.col("m")))
    picked = shown.agg(
        first_key(carrier, True).alias("top"),
        last_key(carrier).alias("low"),
        peak.alias("peak"),
        base.alias("base"),
        first_key(travel_class, True).alias("cls_top"),
        last_key(travel_class).alias("cls_low"),
    )
    return picked.select(
        F.col("top.g").alias("dearest"),
        F.col("top.m").alias("dearest_median"),
        F.col("low.g").alias("cheapest"),
        F.col("low.m").alias("cheapest_median"),
        half_even(F.try_divide(F.col("top.m"), F.col("low.m")), 4).alias("carrier_multiple"),
        F.col("peak.g").alias("peak_season"),
        F.col("peak.m").alias("peak_median"),
        F.col("base").alias("baseline_median"),
        half_even((F.try_divide(F.col("peak.m"), F.col("base")) - 1) * 100, 2).alias("season_premium_pct"),
        F.col("cls_top.g").alias("dearest_class"),
        F.col("cls_low.g").alias("cheapest_class"),
        half_even(F.try_divide(F.col("cls_top.m"), F.col("cls_low.m")), 4).alias("class_multiple"),
    )
