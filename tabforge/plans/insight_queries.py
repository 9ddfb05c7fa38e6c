"""Queries and oracles: insight bundle and report."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.operators import evaluation as E
from tabforge.operators import insights as N
from tabforge.plans import trips as B
from tabforge.plans.model_data import scored_sql, simple_predictions
from tabforge.plans.model_queries import METRICS_SQL
from tabforge.plans.profile_queries import REPORTED, corr_sql, target_sql
from tabforge.plans.summary_queries import RATIO_CTES, WINDOW_SQL, stat
from tabforge.session import materialize, scratch_path
from tabforge.sources import tables as IO

COLUMNS = N.InsightColumns(
    target=B.TARGET,
    carrier="airline",
    season="seasonality",
    origin="source",
    goal="destination",
    travel_class="travel_class",
    stops="stopovers",
    channel="booking_source",
    days="days_left",
    season_order=tuple(B.SEASON_ORDER),
    baseline=B.BASELINE_SEASON,
    numeric=tuple(REPORTED),
)


def _report(spark, d):
    """The report written as a text file and read back as its lines."""
    scored = simple_predictions(spark, d).where("model = 'duration_line' AND split = 'test'")
    r2 = materialize(E.regression_metrics(scored), "model-quality").select("r2").scalar()
    path = scratch_path(spark, "report")
    IO.write_text(N.insight_report(B.flights(spark, d), COLUMNS, r2), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def queries():
    return {
        "insight_bundle": lambda s, d: N.insight_bundle(B.flights(s, d), COLUMNS),
        "insight_report": _report,
    }


def _insight(name: str, key: str, mean: bool, std: bool, extra: str = "") -> str:
    def shown(on: bool, s: str) -> str:
        return f"round_even({stat(s)}, 0)" if on else "CAST(NULL AS DOUBLE)"

    return (
        f"SELECT '{name}' AS insight, {key} AS key, round_even({stat('median')}, 0) AS median_fare, {shown(mean, 'mean')} AS mean_fare, "
        f"{shown(std, 'std')} AS std_fare, count(fare) AS count, CAST(NULL AS DOUBLE) AS r FROM flights GROUP BY 2 {extra}"
    )


def oracles():
    route = "source || ' → ' || destination"
    parts = [
        _insight("airline_pricing", "airline", True, True),
        _insight("seasonal_pricing", "seasonality", True, True),
        _insight("class_pricing", "travel_class", True, False),
        _insight("stopover_pricing", "CAST(stopovers AS VARCHAR)", True, False),
        _insight("booking_source", "booking_source", True, False),
        _insight("days_left_buckets", WINDOW_SQL, False, False, "HAVING key IS NOT NULL"),
        "(" + _insight("top_10_routes", route, False, False, f"ORDER BY {stat('median')} DESC, key LIMIT 10") + ")",
        "(" + _insight("bottom_10_routes", route, False, False, f"ORDER BY {stat('median')}, key DESC LIMIT 10") + ")",
        "SELECT 'correlations', feature, NULL, NULL, NULL, NULL, r FROM (" + target_sql(REPORTED, "flights", 4) + ")",
    ]
    links = {c: f"CAST((SELECT round_even({corr_sql(c, 'fare')}, 3) FROM flights) AS VARCHAR)" for c in ("days_left", "duration")}
    money = "format('{{:,.0f}}', {})".format
    lines = [
        f"'Carriers: ' || dearest || ' has the highest typical fare (' || {money('dearest_median')} || '), ' || cheapest || ' the lowest (' || "
        f"{money('cheapest_median')} || '), a factor of ' || CAST(round_even(carrier_multiple, 2) AS VARCHAR) || '.'",
        f"'Seasons: ' || peak_season || ' has a median of ' || {money('peak_median')} || ', ' || CAST(round_even(season_premium_pct, 1) AS VARCHAR) || "
        f"'% over the baseline (' || {money('baseline_median')} || ').'",
        f"'Routes: the dearest is ' || top.key || ' (' || {money('top.median_fare')} || ').'",
        f"'Booking: days ahead correlate with fare at ' || {links['days_left']} || ', duration at ' || {links['duration']} || '.'",
        "'Classes: ' || dearest_class || ' costs ' || CAST(round_even(class_multiple, 2) AS VARCHAR) || ' times ' || cheapest_class || '.'",
        "'Model: explains ' || CAST(round_even(quality.r2 * 100, 1) AS VARCHAR) || '% of the variation on unseen rows.'",
    ]
    top = _insight("top_10_routes", route, False, False, f"ORDER BY {stat('median')} DESC, key LIMIT 1")
    quality = f"SELECT {METRICS_SQL} FROM scored WHERE model = 'duration_line' AND split = 'test'"
    return {
        "insight_bundle": f"WITH {B.FLIGHTS_SQL} " + " UNION ALL ".join(parts),
        "insight_report": f"WITH {scored_sql()}{RATIO_CTES}, top AS ({top}), quality AS ({quality}) "
        f"SELECT unnest([{', '.join(lines)}]) AS line FROM ratios, top, quality",
    }
