"""Queries and oracles: grouped statistics and KPIs."""

from __future__ import annotations

from tabforge.operators import summaries as S
from tabforge.plans import trips as B

T = B.TARGET
ROUTE = ["source", "destination"]
NATIONS_IN_PIVOT = ["BRAZIL", "CANADA", "CHINA", "FRANCE", "JAPAN"]


def r(expr: str, digits: int) -> str:
    return f"round_even({expr}, {digits})"


def quantile_sql(x: str, p: float) -> str:
    """Interpolated quantile, written out: ``quantile_cont`` fuses a multiply-add away from 0.5."""
    if p == 0.5:
        return f"quantile_cont({x}, 0.5)"
    pos = f"({p} * (len(l) - 1))"
    low, high = f"l[CAST(floor({pos}) AS BIGINT) + 1]", f"l[CAST(ceil({pos}) AS BIGINT) + 1]"
    frac = f"({pos} - floor({pos}))"
    return (
        f"list_transform([list_sort(list({x}) FILTER (WHERE {x} IS NOT NULL))], lambda l: "
        f"CASE WHEN {frac} = 0.5 THEN ({low} + {high}) / 2 WHEN {frac} > 0.5 THEN {high} - ({high} - {low}) * (1 - {frac}) "
        f"ELSE {low} + ({high} - {low}) * {frac} END)[1]"
    )


def stat(name: str, target: str = T) -> str:
    return {
        "count": f"count({target})",
        "mean": f"avg({target})",
        "median": f"quantile_cont({target}, 0.5)",
        "std": f"stddev_samp({target})",
        "p25": quantile_sql(target, 0.25),
        "p75": quantile_sql(target, 0.75),
        "q25": quantile_sql(target, 0.25),
        "q75": quantile_sql(target, 0.75),
        "min": f"min({target})",
        "max": f"max({target})",
    }[name]


def stats_sql(names: list[str], digits: int, target: str = T) -> str:
    return ", ".join(
        f"{stat(n, target)} AS {n}" if n == "count" else f"{r(stat(n, target), digits)} AS {n}" for n in names
    )


def _with(body: str, cte: str = B.FLIGHTS_SQL) -> str:
    return f"WITH {cte} {body}"


def _summary_sql(group: str, names: list[str]) -> str:
    return (
        f"SELECT *, {r('(mean - (SELECT avg(fare) FROM flights)) / (SELECT avg(fare) FROM flights) * 100', 1)} AS pct_vs_avg "
        f"FROM (SELECT {group}, {stats_sql(names, 2)} FROM flights WHERE {group} IS NOT NULL GROUP BY {group})"
    )


FULL = ["count", "mean", "median", "std", "p25", "p75", "min", "max"]
EDA_GROUPS = ["airline", "source", "destination", "seasonality"]


def _sets_sql() -> str:
    parts = [
        f"SELECT '{g}' AS group_col, {g} AS group_value, {stats_sql(FULL, 2)} FROM flights "
        f"WHERE {g} IS NOT NULL GROUP BY {g}"
        for g in EDA_GROUPS
    ]
    return (
        f"SELECT *, {r('(mean - (SELECT avg(fare) FROM flights)) / (SELECT avg(fare) FROM flights) * 100', 1)} AS pct_vs_avg "
        f"FROM ({' UNION ALL '.join(parts)})"
    )


def _pricing_sql(keys: str, stats: list[str]) -> str:
    extra = "".join(f", {r(stat(s), 0)} AS {s}_fare" for s in stats)
    return f"SELECT {keys}, {r(stat('median'), 0)} AS median_fare{extra}, count(fare) AS count FROM flights GROUP BY {keys}"


WINDOW_SQL = (
    "CASE WHEN days_left <= 0 THEN NULL "
    + " ".join(
        f"WHEN days_left <= {e} THEN '{n}'" for e, n in zip(S.WINDOW_EDGES[1:], S.WINDOW_LABELS, strict=True)
    )
    + " END"
)

_ROUTES = (
    f"SELECT source, destination, {r(stat('median'), 0)} AS median_fare, count(fare) AS count, "
    f"{stat('median')} AS m FROM flights GROUP BY source, destination"
)

_PIVOT = (
    "SELECT source, "
    + ", ".join(
        f"{r(f'quantile_cont(fare, 0.5) FILTER (WHERE destination = {chr(39)}{n}{chr(39)})', 2)} AS \"{n}\""
        for n in NATIONS_IN_PIVOT
    )
    + " FROM flights GROUP BY source"
)

RATIO_CTES = f""",
c AS (SELECT airline AS g, {stat("median")} AS m FROM flights GROUP BY 1),
s AS (SELECT seasonality AS g, {stat("median")} AS m FROM flights GROUP BY 1),
k AS (SELECT travel_class AS g, {stat("median")} AS m FROM flights GROUP BY 1),
ratios AS (
  SELECT *, round_even(dearest_median / cheapest_median, 4) AS carrier_multiple,
         round_even((peak_median / baseline_median - 1) * 100, 2) AS season_premium_pct,
         round_even(kt / kb, 4) AS class_multiple
  FROM (SELECT
    (SELECT g FROM c ORDER BY m DESC, g LIMIT 1) AS dearest,
    (SELECT round_even(m, 0) FROM c ORDER BY m DESC, g LIMIT 1) AS dearest_median,
    (SELECT g FROM c ORDER BY m, g DESC LIMIT 1) AS cheapest,
    (SELECT round_even(m, 0) FROM c ORDER BY m, g DESC LIMIT 1) AS cheapest_median,
    (SELECT g FROM s ORDER BY g LIMIT 1) AS peak_season,
    (SELECT round_even(m, 0) FROM s ORDER BY g LIMIT 1) AS peak_median,
    (SELECT round_even(m, 0) FROM s WHERE g = '5-LOW') AS baseline_median,
    (SELECT g FROM k ORDER BY m DESC, g LIMIT 1) AS dearest_class,
    (SELECT g FROM k ORDER BY m, g DESC LIMIT 1) AS cheapest_class,
    (SELECT round_even(m, 0) FROM k ORDER BY m DESC, g LIMIT 1) AS kt,
    (SELECT round_even(m, 0) FROM k ORDER BY m, g DESC LIMIT 1) AS kb)
)"""


def queries():
    def on(fn):
        return lambda spark, d: fn(B.flights(spark, d))

    return {
        "summary_by_group": on(lambda t: S.summary_by_group(t, "airline", T)),
        "summary_grouping_sets": on(lambda t: S.summary_grouping_sets(t, EDA_GROUPS, T)),
        "kpi_avg_by_group": on(lambda t: S.kpi_by_group(t, "airline", T)),
        "top_routes_by_count": on(lambda t: S.top_pairs_by_count(t, *ROUTE, T, 10)),
        "group_vs_baseline": on(lambda t: S.group_vs_baseline(t, "seasonality", T, B.BASELINE_SEASON)),
        "top_routes_by_mean": on(lambda t: S.top_pairs_by_mean(t, *ROUTE, T, 5)),
        "pricing_by_group": on(lambda t: S.pricing(t, ["airline"], T)),
        "pricing_fixed_order": on(lambda t: S.pricing_fixed_order(t, "seasonality", T, B.SEASON_ORDER[:4])),
        "route_pricing": on(lambda t: S.pricing(t, ROUTE, T, ())),
        "route_top_bottom": on(lambda t: S.top_and_bottom(t, ROUTE, T, 10)),
        "pricing_by_class": on(lambda t: S.pricing(t, ["travel_class"], T, ("mean",))),
        "pricing_by_ordinal": on(lambda t: S.pricing(t, ["stopovers"], T, ("mean",))),
        "pricing_by_channel": on(lambda t: S.pricing(t, ["booking_source"], T, ("mean",))),
        "bucket_pricing": on(lambda t: S.bucket_pricing(t, "days_left", T)),
        "bucket_quartiles": on(lambda t: S.bucket_quartiles(t, "days_left", T)),
        "premium_ratios": on(
            lambda t: S.premium_ratios(
                t, "airline", "seasonality", "travel_class", T, B.SEASON_ORDER, B.BASELINE_SEASON
            )
        ),
        "monthly_trend": on(lambda t: S.monthly_trend(t, "departure_month", T)),
        "season_stats": on(lambda t: S.season_stats(t, "seasonality", T)),
        "season_premium": on(
            lambda t: S.season_premium(t, "seasonality", T, [*B.SEASON_ORDER, "6-ABSENT"], B.BASELINE_SEASON)
        ),
        "route_pivot": on(lambda t: S.pair_pivot(t, *ROUTE, NATIONS_IN_PIVOT, T)),
        "component_summary": on(lambda t: S.component_summary(t, ["fare", "base_fare", "tax_surcharge"])),
    }


def oracles():
    base = "(SELECT round_even(avg(fare), 2) FROM flights WHERE seasonality = '5-LOW')"
    component = " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {r(f'avg({c})', 2)} AS mean, {r(f'quantile_cont({c}, 0.5)', 2)} AS median, "
        f"{r(f'skewness({c})', 3)} AS skew FROM flights"
        for c in ("fare", "base_fare", "tax_surcharge")
    )
    months = ", ".join(f"'{m}'" for m in S.MONTHS)
    seasons = ", ".join(f"({i}, '{s}')" for i, s in enumerate([*B.SEASON_ORDER, "6-ABSENT"]))
    return {
        "summary_by_group": _with(_summary_sql("airline", FULL)),
        "summary_grouping_sets": _with(_sets_sql()),
        "kpi_avg_by_group": _with(_summary_sql("airline", ["count", "mean", "median", "std"])),
        "top_routes_by_count": _with(
            f"SELECT source, destination, count(fare) AS flight_count, {r('avg(fare)', 2)} AS mean_fare, "
            f"{r(stat('median'), 2)} AS median_fare, source || ' → ' || destination AS route FROM flights "
            "GROUP BY source, destination ORDER BY flight_count DESC, source, destination LIMIT 10"
        ),
        "group_vs_baseline": _with(
            f"SELECT *, {r(f'(mean - {base}) / {base} * 100', 1)} AS pct_vs_regular FROM (SELECT seasonality, "
            f"{stats_sql(['count', 'mean', 'median', 'std', 'min', 'max'], 2)} FROM flights GROUP BY seasonality)"
        ),
        "top_routes_by_mean": _with(
            f"SELECT source, destination, {stats_sql(['count', 'mean', 'median', 'std', 'max'], 2)}, "
            "source || ' → ' || destination AS route FROM flights GROUP BY source, destination "
            "ORDER BY mean DESC, source, destination LIMIT 5"
        ),
        "pricing_by_group": _with(_pricing_sql("airline", ["mean", "std"])),
        "pricing_fixed_order": _with(
            "SELECT CAST(CASE WHEN seasonality = '5-LOW' THEN 5 ELSE CAST(seasonality[1] AS INTEGER) END AS INTEGER) AS sort_key, "
            "CASE WHEN seasonality <> '5-LOW' THEN seasonality END AS seasonality, median_fare, mean_fare, std_fare, count "
            f"FROM ({_pricing_sql('seasonality', ['mean', 'std'])})"
        ),
        "route_pricing": _with(_pricing_sql("source, destination", [])),
        "route_top_bottom": _with(
            f", q AS ({_ROUTES}) SELECT * FROM (SELECT 'top' AS side, source, destination, median_fare, count FROM q "
            "ORDER BY m DESC, source, destination LIMIT 10) UNION ALL "
            "SELECT * FROM (SELECT 'bottom' AS side, source, destination, median_fare, count FROM q "
            "ORDER BY m, source DESC, destination DESC LIMIT 10)"
        ),
        "pricing_by_class": _with(_pricing_sql("travel_class", ["mean"])),
        "pricing_by_ordinal": _with(_pricing_sql("stopovers", ["mean"])),
        "pricing_by_channel": _with(_pricing_sql("booking_source", ["mean"])),
        "bucket_pricing": _with(
            f"SELECT {WINDOW_SQL} AS booking_window, {r(stat('median'), 0)} AS median_fare, count(fare) AS count "
            "FROM flights GROUP BY 1 HAVING booking_window IS NOT NULL"
        ),
        "bucket_quartiles": _with(
            f"SELECT {WINDOW_SQL} AS booking_window, {stats_sql(['median', 'q25', 'q75'], 4)} "
            "FROM flights GROUP BY 1 HAVING booking_window IS NOT NULL"
        ),
        "premium_ratios": _with(RATIO_CTES + " SELECT * EXCLUDE (kt, kb) FROM ratios"),
        "monthly_trend": _with(
            f"SELECT departure_month, [{months}][departure_month] AS month_name, {stats_sql(['mean', 'median', 'std'], 2)}, "
            f"{r('avg(fare) - stddev_samp(fare)', 2)} AS band_low, {r('avg(fare) + stddev_samp(fare)', 2)} AS band_high "
            "FROM flights GROUP BY departure_month"
        ),
        "season_stats": _with(f"SELECT seasonality, {stats_sql(['mean', 'median', 'std'], 2)} FROM flights GROUP BY 1"),
        "season_premium": _with(
            f", q AS (SELECT seasonality, {stat('median')} AS m FROM flights GROUP BY 1), "
            f"w(position, seasonality) AS (VALUES {seasons}) "
            f"SELECT position, w.seasonality, {r('m', 2)} AS median_fare, "
            f"{r(chr(40) + 'm - (SELECT m FROM q WHERE seasonality = ' + chr(39) + '5-LOW' + chr(39) + ')) / (SELECT m FROM q WHERE seasonality = ' + chr(39) + '5-LOW' + chr(39) + ') * 100', 1)} AS pct_over_baseline "
            "FROM w LEFT JOIN q ON w.seasonality = q.seasonality"
        ),
        "route_pivot": _with(_PIVOT),
        "component_summary": _with(component),
    }
