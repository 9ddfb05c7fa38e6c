"""Queries and oracles: profiling, data quality, correlation and distributions."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import functions as F

from tabforge.operators import correlation as C
from tabforge.operators import distributions as D
from tabforge.operators import profiling as P
from tabforge.plans import trips as B
from tabforge.plans.summary_queries import quantile_sql, r

T = B.TARGET
PROFILED = {
    "trip_key": "string",
    "airline": "string",
    "seasonality": "string",
    "travel_class": "string",
    "duration": "double",
    "days_left": "bigint",
    "stopovers": "int",
    "departure_hour": "int",
    "fare": "double",
}
NUMBERS = [c for c, t in PROFILED.items() if t != "string"]
TEXTS = [c for c, t in PROFILED.items() if t == "string"]
CATEGORIES = ["airline", "source", "seasonality", "travel_class"]
REPEATED = ["airline", "source", "travel_class", "seasonality", "departure_hour"]
TEMPORAL = ["departure_hour", "departure_day_of_week", "departure_month", "stopovers", "booking_source"]
# The numeric columns of the insight report.
REPORTED = ["duration", "days_left", "departure_hour", "departure_month", "arrival_hour", "stopovers"]
KDE_POINTS, VIOLIN_POINTS = 50, 25


def _gaps(body: str) -> str:
    return f"WITH {B.GAPS_SQL} {body}"


def _flights(body: str) -> str:
    return f"WITH {B.FLIGHTS_SQL} {body}"


def each(template: str, columns: list[str], **extra) -> str:
    return " UNION ALL ".join(template.format(c=c, i=i, **extra) for i, c in enumerate(columns))


def corr_sql(a: str, b: str) -> str:
    return f"CASE WHEN regr_sxx({a}, {b}) > 0 AND regr_syy({a}, {b}) > 0 THEN corr({a}, {b}) END"


def pairs_sql(pairs: list[tuple[str, str]], source: str, digits: int) -> str:
    return " UNION ALL ".join(
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, {r(corr_sql(a, b), digits)} AS r FROM {source}"
        for a, b in pairs
    )


def matrix_sql(columns: list[str], source: str) -> str:
    both = [(a, b) for a in columns for b in columns]
    return pairs_sql(both, source, 3)


def target_sql(columns: list[str], source: str, digits: int, name: str = "r") -> str:
    return " UNION ALL ".join(
        f"SELECT '{c}' AS feature, {r(corr_sql(c, T), digits)} AS {name} FROM {source}" for c in columns
    )


def ranks_cte(columns: list[str], source: str = "flights") -> str:
    ranked = ", ".join(
        f"rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0 AS {c}" for c in columns
    )
    return f", ranked AS (SELECT {ranked} FROM {source})"


WITH_GAPS = ["duration", "days_left", "stopovers"]
SPEARMAN = ["duration", "days_left", "stopovers", "departure_hour", "departure_month", "arrival_month"]

_QUART = {p: quantile_sql("{c}", p) for p in (0.25, 0.75)}
_DESCRIBE = (
    "SELECT '{c}' AS \"column\", count({c}) AS count, round_even(avg({c}), 2) AS mean, "
    "round_even(stddev_samp({c}), 2) AS std, round_even(min({c}), 2) AS min, "
    + f"round_even({_QUART[0.25]}, 2) AS p25, round_even(quantile_cont({{c}}, 0.5), 2) AS median, "
    + f"round_even({_QUART[0.75]}, 2) AS p75, round_even(max({{c}}), 2) AS max FROM gaps"
)
_TOP = (
    "SELECT '{c}' AS \"column\", count({c}) AS count, count(DISTINCT {c}) AS \"unique\", "
    "(SELECT {c} FROM gaps WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS top, "
    "(SELECT count(*) FROM gaps WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1) AS freq FROM gaps"
)


def _outliers(c: str) -> str:
    q1, q3 = quantile_sql(c, 0.25), quantile_sql(c, 0.75)
    return (
        f"SELECT '{c}' AS \"column\", round_even(any_value(lo), 4) AS lower, round_even(any_value(hi), 4) AS upper, "
        f"count(*) FILTER (WHERE {c} < lo OR {c} > hi) AS outliers, "
        f"round_even(count(*) FILTER (WHERE {c} < lo OR {c} > hi) * 100.0 / count({c}), 2) AS outlier_pct "
        f"FROM gaps, (SELECT q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM "
        f"(SELECT {q1} AS q1, {q3} AS q3 FROM gaps))"
    )


def _histogram(scale: str, expr: str, bins: int) -> str:
    return (
        f"SELECT '{scale}' AS scale, CAST(least(floor((x - lo) / w), {bins - 1}) AS INTEGER) AS bin, lo, w, n FROM "
        f"(SELECT {expr} AS x FROM flights), "
        f"(SELECT lo, (hi - lo) / {bins}.0 AS w, n FROM (SELECT min({expr}) AS lo, max({expr}) AS hi, count(*) AS n FROM flights))"
    )


def _kde(group: str, points: int) -> str:
    return (
        f"SELECT g, i, round_even(lo + i * (hi - lo) / {points - 1}.0, 4) AS x, "
        f"round_even(sum(c * exp(-0.5 * ((v - (lo + i * (hi - lo) / {points - 1}.0)) / h) ** 2)) / (n * h * sqrt(2 * pi())), 10) AS density "
        f"FROM (SELECT {group} AS g, fare AS v, count(*) AS c FROM flights GROUP BY 1, 2) "
        f"JOIN (SELECT {group} AS g, count(*) AS n, min(fare) AS lo, max(fare) AS hi, "
        f"stddev_samp(fare) * pow(count(*), -0.2) AS h FROM flights GROUP BY 1) USING (g), "
        f"(SELECT CAST(i AS INTEGER) AS i FROM range({points}) t(i)) GROUP BY g, i, n, lo, hi, h"
    )


def queries():
    def on(fn, source=B.flights):
        return lambda spark, d: fn(source(spark, d))

    def profiled(spark, d):
        return B.gaps(spark, d).select(*PROFILED)

    return {
        "profile_structure": on(P.structure, profiled),
        "describe_numeric": on(lambda t: P.describe_numeric(t, NUMBERS), B.gaps),
        "describe_all": on(lambda t: P.describe_all(t, NUMBERS, TEXTS), B.gaps),
        "missing_audit": on(P.missing_audit, profiled),
        "total_missing": on(P.total_missing, profiled),
        "duplicate_rows": on(lambda t: P.duplicate_rows(t.select(*REPEATED)), B.gaps),
        "detect_timestamp_cols": on(lambda t: P.detect_timestamps(_texts(t))),
        "classify_columns": on(lambda t: P.classify_columns(_texts(t))),
        "categorical_profile": on(lambda t: P.categorical_profile(t, CATEGORIES), B.gaps),
        "numeric_profile": on(lambda t: P.numeric_profile(t, NUMBERS), B.gaps),
        "iqr_outliers": on(lambda t: P.iqr_outliers(t, NUMBERS), B.gaps),
        "target_summary": on(lambda t: P.target_summary(t, T), B.gaps),
        "value_counts": on(lambda t: P.value_counts(t, TEMPORAL)),
        "column_cardinality": on(lambda t: P.column_cardinality(t, [*CATEGORIES, "stopovers", "departure_hour"])),
        "leakage_correlation": on(lambda t: C.corr_with_target(t, ["base_fare", "tax_surcharge"], T, 4)),
        "corr_matrix": on(lambda t: C.corr_matrix(t, B.NUMERICAL, T), B.gaps),
        "corr_spearman": on(lambda t: C.corr_spearman(t, SPEARMAN, T)),
        "corr_spearman_gaps": on(lambda t: C.corr_spearman(t, WITH_GAPS, T), B.gaps),
        "corr_target_ranked": on(lambda t: C.corr_with_target(t, B.NUMERICAL, T), B.gaps),
        "corr_bar": on(lambda t: C.corr_bar(C.corr_with_target(t, [*B.NUMERICAL, "base_fare"], T)), B.gaps),
        "corr_json": on(lambda t: C.corr_json(C.corr_matrix(t, B.NUMERICAL, T), [*B.NUMERICAL, T]), B.gaps),
        "high_corr_pairs": on(lambda t: C.high_corr_pairs(t, [*B.NUMERICAL, "base_fare", T], 0.7)),
        "numeric_correlations": on(lambda t: C.corr_with_target(t, REPORTED, T, 4), B.gaps),
        "corr_method_delta": on(lambda t: C.method_delta(t, SPEARMAN, T)),
        "corr_top_n": on(lambda t: C.corr_with_target(t, [*B.NUMERICAL, "base_fare"], T).limit(4)),
        "histogram": on(lambda t: D.histogram(t, T, 80, ("raw", "sqrt", "log1p"))),
        "kde_grid": on(lambda t: D.kde(t, T, KDE_POINTS)),
        "violin_data": on(lambda t: D.violin(t, "seasonality", T, VIOLIN_POINTS)),
        "boxplot_stats": on(lambda t: D.boxplot_stats(t, "airline", T)),
    }


_TEXTS_SQL = {
    "airline": "airline",
    "stopover_label": "stopover_label",
    "number_text": "CAST(split_key AS VARCHAR)",
    "departure_text": "strftime(departure_datetime, '%Y-%m-%d %H:%M:%S')",
    "arrival_text": "CASE WHEN line_no % 2 = 0 THEN strftime(arrival_datetime, '%-m/%-d/%Y %-H:%M') ELSE strftime(arrival_datetime, '%Y-%m-%d %H:%M:%S') END",
}


def _all_parse(x):
    return f"bool_and(try_strptime({x}, ['%Y-%m-%d %H:%M:%S', '%m/%d/%Y %H:%M']) IS NOT NULL)"


def _spearman_sql(a, b):
    """Spearman's r of two columns on the rows that have both, by average ranks."""
    rank = "rank() OVER (ORDER BY {c}) + (count(*) OVER (PARTITION BY {c}) - 1) / 2.0"
    return (
        f"SELECT '{a}' AS feature_a, '{b}' AS feature_b, round_even(corr(ra, rb), 3) AS r FROM (SELECT {rank.format(c=a)} AS ra, "
        f"{rank.format(c=b)} AS rb FROM gaps WHERE {a} IS NOT NULL AND {b} IS NOT NULL)"
    )


def _texts(t):
    """Text columns of which two hold timestamps in mixed notations."""
    iso = F.date_format("departure_datetime", "yyyy-MM-dd HH:mm:ss")
    slashed = F.date_format("arrival_datetime", "M/d/yyyy H:mm")
    return t.select(
        "airline",
        "stopover_label",
        F.col("split_key").cast("string").alias("number_text"),
        iso.alias("departure_text"),
        F.when(F.col("line_no") % 2 == 0, slashed).otherwise(F.date_format("arrival_datetime", "yyyy-MM-dd HH:mm:ss")).alias("arrival_text"),
        "fare",
        "days_left",
    )


def oracles():
    structure = " UNION ALL ".join(
        f"SELECT CAST({i} AS INTEGER) AS position, '{c}' AS \"column\", '{t}' AS dtype, count({c}) AS non_null, "
        f"count(*) - count({c}) AS nulls, count(*) AS rows FROM gaps"
        for i, (c, t) in enumerate(PROFILED.items())
    )
    hist = " UNION ALL ".join(
        _histogram(s, e, 80) for s, e in (("raw", "fare"), ("sqrt", "sqrt(fare)"), ("log1p", "ln(1 + fare)"))
    )
    q1, q3 = quantile_sql("fare", 0.25), quantile_sql("fare", 0.75)
    dtype = {c: "string" for c in CATEGORIES} | {"stopovers": "int", "departure_hour": "int"}
    quart = f"SELECT seasonality AS g, {r(q1, 2)} AS q1, {r('quantile_cont(fare, 0.5)', 2)} AS median, {r(q3, 2)} AS q3 FROM flights GROUP BY 1"
    target = target_sql([*B.NUMERICAL, "base_fare"], "flights", 3)
    bars = target_sql([*B.NUMERICAL, "base_fare"], "gaps", 3)
    lower = [(b, a) for a, b in combinations([*B.NUMERICAL, "base_fare", T], 2)]
    rank_cols = [*SPEARMAN, T]
    return {
        "profile_structure": _gaps(structure),
        "describe_numeric": _gaps(each(_DESCRIBE, NUMBERS)),
        "describe_all": _gaps(
            each(_DESCRIBE, NUMBERS).replace(" FROM gaps", ', CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq FROM gaps')
            + " UNION ALL BY NAME "
            + " UNION ALL BY NAME ".join(_TOP.format(c=c) for c in TEXTS)
        ),
        "missing_audit": _gaps(
            'SELECT "column", nulls AS missing_count, round_even(nulls * 100.0 / rows, 2) AS missing_pct '
            f"FROM ({structure}) WHERE nulls > 0"
        ),
        "total_missing": _gaps(f"SELECT CAST(sum(nulls) AS BIGINT) AS missing_cells FROM ({structure})"),
        "duplicate_rows": _gaps(
            "SELECT CAST(sum(n) - count(*) AS BIGINT) AS duplicate_rows, "
            "round_even((sum(n) - count(*)) * 100.0 / sum(n), 2) AS duplicate_pct "
            f"FROM (SELECT count(*) AS n FROM gaps GROUP BY {', '.join(REPEATED)})"
        ),
        "categorical_profile": _gaps(" UNION ALL ".join(_TOP.format(c=c) for c in CATEGORIES)),
        "numeric_profile": _gaps(
            each(
                "SELECT '{c}' AS \"column\", round_even(min({c}), 2) AS min, round_even(max({c}), 2) AS max, "
                "round_even(skewness({c}), 4) AS skew FROM gaps",
                NUMBERS,
            )
        ),
        "iqr_outliers": _gaps(" UNION ALL ".join(_outliers(c) for c in NUMBERS)),
        "target_summary": _gaps(
            "SELECT 'fare' AS target, round_even(min(fare), 2) AS min, round_even(max(fare), 2) AS max, "
            "round_even(avg(fare), 2) AS mean, round_even(quantile_cont(fare, 0.5), 2) AS median FROM gaps"
        ),
        "value_counts": _flights(
            each('SELECT \'{c}\' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS count FROM flights GROUP BY {c}', TEMPORAL)
        ),
        "column_cardinality": _flights(
            " UNION ALL ".join(
                f"SELECT '{c}' AS \"column\", '{t}' AS dtype, count(DISTINCT {c}) AS n_unique, "
                f"min(CAST({c} AS VARCHAR)) AS sample FROM flights"
                for c, t in dtype.items()
            )
        ),
        "leakage_correlation": _flights(target_sql(["base_fare", "tax_surcharge"], "flights", 4)),
        "corr_matrix": _gaps(matrix_sql([*B.NUMERICAL, T], "gaps")),
        "corr_spearman_gaps": _gaps(" UNION ALL ".join(_spearman_sql(a, b) for a in [*WITH_GAPS, T] for b in [*WITH_GAPS, T])),
        "detect_timestamp_cols": _flights(
            " UNION ALL ".join(f"SELECT '{n}' AS \"column\", {_all_parse(x)} AS is_timestamp FROM flights" for n, x in _TEXTS_SQL.items())
        ),
        "classify_columns": _flights(
            " UNION ALL ".join(
                [f"SELECT '{n}' AS \"column\", CASE WHEN {_all_parse(x)} THEN 'datetime' ELSE 'categorical' END AS kind FROM flights" for n, x in _TEXTS_SQL.items()]
                + [f"SELECT '{n}' AS \"column\", 'numerical' AS kind" for n in ("fare", "days_left")]
            )
        ),
        "corr_spearman": _flights(ranks_cte(rank_cols) + matrix_sql(rank_cols, "ranked")),
        "corr_target_ranked": _gaps(target_sql(B.NUMERICAL, "gaps", 3)),
        "corr_bar": _gaps(
            "SELECT feature, r, (CASE WHEN r >= 0 THEN '+' ELSE '-' END) || repeat('█', CAST(round_even(abs(r) * 20, 0) AS BIGINT)) "
            f"|| repeat('░', 20 - CAST(round_even(abs(r) * 20, 0) AS BIGINT)) AS bar FROM ({bars})"
        ),
        "high_corr_pairs": _flights(f"SELECT * FROM ({pairs_sql(lower, 'flights', 3)}) WHERE abs(r) > 0.7"),
        "numeric_correlations": _gaps(target_sql(REPORTED, "gaps", 4)),
        "corr_method_delta": _flights(
            ranks_cte(rank_cols)
            + f"SELECT coalesce(a.feature, b.feature) AS feature, pearson, spearman, round_even(spearman - pearson, 3) AS delta "
            f"FROM ({target_sql(SPEARMAN, 'flights', 3, 'pearson')}) a FULL JOIN "
            f"({target_sql(SPEARMAN, 'ranked', 3, 'spearman')}) b ON a.feature = b.feature"
        ),
        "corr_top_n": _flights(f"SELECT * FROM ({target}) ORDER BY abs(r) DESC, feature LIMIT 4"),
        "histogram": _flights(
            "SELECT scale, bin, round_even(lo + bin * w, 4) AS left_edge, round_even(lo + (bin + 1) * w, 4) AS right_edge, "
            f"count(*) AS count, round_even(count(*) / (n * w), 8) AS density FROM ({hist}) GROUP BY scale, bin, lo, w, n"
        ),
        "kde_grid": _flights("SELECT g AS series, * EXCLUDE (g) FROM (" + _kde("'fare'", KDE_POINTS) + ")"),
        "violin_data": _flights(
            f"SELECT k.g AS seasonality, i, x, density, q1, median, q3 FROM ({_kde('seasonality', VIOLIN_POINTS)}) k JOIN ({quart}) q ON k.g = q.g"
        ),
        "boxplot_stats": _flights(
            f", b AS (SELECT airline, q1, m, q3, q1 - 1.5 * (q3 - q1) AS lo, q3 + 1.5 * (q3 - q1) AS hi FROM "
            f"(SELECT airline, {q1} AS q1, quantile_cont(fare, 0.5) AS m, {q3} AS q3 FROM flights GROUP BY 1)) "
            "SELECT airline, round_even(q1, 2) AS q1, round_even(m, 2) AS median, round_even(q3, 2) AS q3, "
            "round_even(min(fare) FILTER (WHERE fare BETWEEN lo AND hi), 2) AS whisker_low, "
            "round_even(max(fare) FILTER (WHERE fare BETWEEN lo AND hi), 2) AS whisker_high, "
            "count(*) FILTER (WHERE fare < lo OR fare > hi) AS outliers "
            "FROM flights JOIN b USING (airline) GROUP BY airline, q1, m, q3"
        ),
    }
