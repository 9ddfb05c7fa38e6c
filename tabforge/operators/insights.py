"""The insight bundle and the plain-language report made from it."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import half_even
from tabforge.operators.correlation import corr_with_target
from tabforge.operators.quantiles import group_stats
from tabforge.operators.summaries import booking_window, ratios_from
from tabforge.session import materialize


@dataclass(frozen=True)
class InsightColumns:
    target: str
    carrier: str
    season: str
    origin: str
    goal: str
    travel_class: str
    stops: str
    channel: str
    days: str
    season_order: tuple[str, ...]
    baseline: str
    numeric: tuple[str, ...]

    @property
    def route(self) -> Column:
        return F.concat(F.col(self.origin), F.lit(" → "), F.col(self.goal))


# Which statistics each insight shows beside median and count.
_SHOWS_MEAN = ("airline_pricing", "seasonal_pricing", "class_pricing", "stopover_pricing", "booking_source")
_SHOWS_STD = ("airline_pricing", "seasonal_pricing")


def insight_groups(df: DataFrame, cols: InsightColumns) -> DataFrame:
    """Statistics of every group of every insight, from one scan pair over the table, stored."""
    keys = {
        "airline_pricing": F.col(cols.carrier),
        "seasonal_pricing": F.col(cols.season),
        "route": cols.route,
        "class_pricing": F.col(cols.travel_class),
        "stopover_pricing": F.col(cols.stops).cast("string"),
        "booking_source": F.col(cols.channel),
        "days_left_buckets": booking_window(cols.days),
    }
    long = df.select(cols.target, *[c.alias(n) for n, c in keys.items()]).unpivot(
        [cols.target], list(keys), "insight", "key"
    )
    known = long.where(F.col("key").isNotNull())
    return materialize(
        group_stats(known, ["insight", "key"], cols.target, {"median": 0.5}, ("mean", "std")), "insights"
    )


def insight_bundle(df: DataFrame, cols: InsightColumns, n: int = 10) -> DataFrame:
    """All insights in one long table; top and bottom routes instead of all routes."""
    groups = insight_groups(df, cols)
    routes = groups.where(F.col("insight") == "route")
    top = routes.orderBy(F.desc("median"), "key").limit(n).withColumn("insight", F.lit("top_10_routes"))
    bottom = routes.orderBy("median", F.desc("key")).limit(n).withColumn("insight", F.lit("bottom_10_routes"))
    rows = groups.where(F.col("insight") != "route").unionByName(top).unionByName(bottom)
    season = F.col("insight") == "seasonal_pricing"
    listed = F.col("key").isin(list(cols.season_order))
    tables = rows.select(
        "insight",
        F.when(~season | listed, F.col("key")).alias("key"),
        half_even("median").alias("median_fare"),
        F.when(F.col("insight").isin(*_SHOWS_MEAN), half_even("mean")).alias("mean_fare"),
        F.when(F.col("insight").isin(*_SHOWS_STD), half_even("std")).alias("std_fare"),
        "count",
    )
    numbers = corr_with_target(df, list(cols.numeric), cols.target, 4).select(
        F.lit("correlations").alias("insight"), F.col("feature").alias("key"), "r"
    )
    return tables.unionByName(numbers, allowMissingColumns=True)


def insight_report(df: DataFrame, cols: InsightColumns, r2: Column) -> DataFrame:
    """One-row text report. ``r2`` is the measured quality of the model in use."""
    groups = insight_groups(df, cols)
    named = groups.withColumnsRenamed({"insight": "group_col", "key": "group_value"})
    ratios = ratios_from(
        named, "airline_pricing", "seasonal_pricing", "class_pricing", list(cols.season_order), cols.baseline
    )
    top = groups.where(F.col("insight") == "route").orderBy(F.desc("median"), "key").limit(1)
    links = materialize(corr_with_target(df, ["days_left", "duration"], cols.target, 3), "report-links")

    def link(feature: str) -> Column:
        return links.where(F.col("feature") == feature).select("r").scalar()

    def money(c: Column) -> Column:
        return F.format_number(c, 0)

    def number(c: Column, digits: int) -> Column:
        return half_even(c, digits).cast("string")

    lines = [
        F.concat(F.lit("Carriers: "), F.col("dearest"), F.lit(" has the highest typical fare ("), money(F.col("dearest_median")), F.lit("), "),
                 F.col("cheapest"), F.lit(" the lowest ("), money(F.col("cheapest_median")), F.lit("), a factor of "), number(F.col("carrier_multiple"), 2), F.lit(".")),
        F.concat(F.lit("Seasons: "), F.col("peak_season"), F.lit(" has a median of "), money(F.col("peak_median")), F.lit(", "),
                 number(F.col("season_premium_pct"), 1), F.lit("% over the baseline ("), money(F.col("baseline_median")), F.lit(").")),
        F.concat(F.lit("Routes: the dearest is "), top.select("key").scalar(), F.lit(" ("), money(top.select(half_even("median")).scalar()), F.lit(").")),
        F.concat(F.lit("Booking: days ahead correlate with fare at "), link("days_left").cast("string"), F.lit(", duration at "), link("duration").cast("string"), F.lit(".")),
        F.concat(F.lit("Classes: "), F.col("dearest_class"), F.lit(" costs "), number(F.col("class_multiple"), 2), F.lit(" times "), F.col("cheapest_class"), F.lit(".")),
        F.concat(F.lit("Model: explains "), number(r2 * 100, 1), F.lit("% of the variation on unseen rows.")),
    ]
    return ratios.select(F.concat_ws("\n", *lines).alias("report"))
