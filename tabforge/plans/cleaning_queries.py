"""Queries and oracles: sources, sinks, cleaning, lookups and scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tabforge.functions.numeric import half_even
from tabforge.operators import cleaning as K
from tabforge.operators import lookups as L
from tabforge.operators import summaries as S
from tabforge.operators.features import target_means
from tabforge.plans import trips as B
from tabforge.plans.summary_queries import oracles as summary_oracles

from tabforge.session import materialize, scratch_path
from tabforge.sources import tables as IO

# Raw column names and the names used after cleaning.
RENAME = {
    "Airline": "airline",
    "Source": "source",
    "Source Name": "source_name",
    "Destination": "destination",
    "Destination Name": "destination_name",
    "Stopovers": "stopovers",
    "Aircraft Type": "aircraft_type",
    "Class": "travel_class",
    "Booking Source": "booking_source",
    "Seasonality": "seasonality",
    "Duration (hrs)": "duration",
    "Days Before Departure": "days_left",
    "Total Fare (BDT)": "fare",
    "Base Fare (BDT)": "base_fare",
    "Tax & Surcharge (BDT)": "tax_surcharge",
    "Departure Date & Time": "departure_datetime",
    "Arrival Date & Time": "arrival_datetime",
}
CONFIG = K.CleaningConfig(
    rename=RENAME,
    leakage=("Base Fare (BDT)", "Tax & Surcharge (BDT)"),
    ordinal={"stopovers": tuple(B.STOPOVER_ORDER)},
)
# The columns a sparse row keeps: too few of the fifteen that remain.
KEPT_IN_SPARSE = {"Source", "Destination", "Class", "Booking Source", "Total Fare (BDT)"}
_HOLES = {"Airline": "part_no % 13 = 0", "Duration (hrs)": "part_no % 11 = 0", "Days Before Departure": "line_no = 3"}
_SPARSE = "part_no % 97 = 5"
IMPUTED = ["duration", "days_left", "fare"]


def raw(spark, d):
    """``trips`` under raw names, with text timestamps, gaps and some nearly empty rows."""
    t = B.flights(spark, d)
    iso, slashed = "yyyy-MM-dd HH:mm:ss", "M/d/yyyy H:mm"
    sources = {v: F.col(v) for v in RENAME.values() if v != "stopovers"}
    sources["stopovers"] = F.col("stopover_label")
    for side in ("departure_datetime", "arrival_datetime"):
        sources[side] = F.when(F.col("line_no") % 2 == 0, F.date_format(side, slashed)).otherwise(
            F.date_format(side, iso)
        )
    out = [F.col("part_no").alias("Unnamed: 0")]
    for old, new in RENAME.items():
        hole = F.expr(_HOLES.get(old, "false"))
        if old not in KEPT_IN_SPARSE:
            hole = hole | F.expr(_SPARSE)
        out.append(F.when(~hole, sources[new]).alias(old))
    return t.select(*out)


def _raw_sql() -> str:
    cols = ['part_no AS "Unnamed: 0"']
    for old, new in RENAME.items():
        hole = _HOLES.get(old, "false")
        if old not in KEPT_IN_SPARSE:
            hole = f"({hole}) OR {_SPARSE}"
        value = {"stopovers": "stopover_label"}.get(new, new)
        if new.endswith("_datetime"):
            value = f"CASE WHEN line_no % 2 = 0 THEN strftime({new}, '%-m/%-d/%Y %-H:%M') ELSE strftime({new}, '%Y-%m-%d %H:%M:%S') END"
        cols.append(f'CASE WHEN NOT ({hole}) THEN {value} END AS "{old}"')
    return B.TRIPS_SQL + f", raw AS (SELECT {', '.join(cols)} FROM trips)"


def _parsed_sql(c: str) -> str:
    return f"coalesce(try_strptime({c}, '%Y-%m-%d %H:%M:%S'), try_strptime({c}, '%m/%d/%Y %H:%M'))"


_RENAMED = ", ".join(f'"{old}" AS {new}' for old, new in RENAME.items())
_KEPT = [c for c in RENAME.values() if c not in ("base_fare", "tax_surcharge")]
_PRESENT = " + ".join(f"(CASE WHEN {c} IS NULL THEN 0 ELSE 1 END)" for c in _KEPT)


def _clean_sql(final: str) -> str:
    parts = ", ".join(
        f"CAST({fn}({_parsed_sql(side + '_datetime')}){shift} AS INTEGER) AS {side}_{name}"
        for side in ("departure", "arrival")
        for name, fn, shift in (("hour", "hour", ""), ("day_of_week", "isodow", " - 1"), ("month", "month", ""))
    )
    plain = [c for c in _KEPT if not c.endswith("_datetime") and c not in ("stopovers", "airline", "duration", "days_left")]
    return (
        f"WITH {_raw_sql()}, kept AS (SELECT {', '.join(_KEPT)} FROM (SELECT {_RENAMED} FROM raw) WHERE {_PRESENT} >= 7), "
        f"cleaned AS (SELECT {', '.join(plain)}, coalesce(airline, 'Unknown') AS airline, "
        "coalesce(duration, (SELECT quantile_cont(duration, 0.5) FROM kept)) AS duration, "
        "coalesce(CAST(days_left AS DOUBLE), (SELECT quantile_cont(CAST(days_left AS DOUBLE), 0.5) FROM kept)) AS days_left, "
        f"CAST(list_position(['A','N','R'], stopovers) - 1 AS INTEGER) AS stopovers, {parts} FROM kept) {final}"
    )


def _gaps(body: str) -> str:
    return f"WITH {B.GAPS_SQL} {body}"


def _flights(body: str) -> str:
    return f"WITH {B.FLIGHTS_SQL} {body}"


_SAVED = ["trip_key", "airline", "stopovers", "duration", "days_left", "departure_hour", "fare"]
_LINE = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"]


def _scan_csv(spark, d):
    df = B.flights(spark, d).select(*_SAVED)
    path = scratch_path(spark, "csv")
    IO.write_csv(df, path)
    return IO.read_csv(spark, path, df.schema)


def _scan_parquet(spark, d):
    return B.table(spark, d, "lineitem").select(*_LINE).where("l_quantity > 45 AND l_returnflag = 'R'")


def _parquet_roundtrip(spark, d):
    df = B.flights(spark, d).select(*_SAVED)
    path = scratch_path(spark, "processed")
    IO.write_parquet(df, path)
    return IO.read_parquet(spark, path)


def _csv_roundtrip(spark, d):
    df = S.kpi_by_group(B.flights(spark, d), "airline", B.TARGET)
    path = scratch_path(spark, "table-csv")
    IO.write_csv(df, path)
    return IO.read_csv(spark, path, df.schema)


def _json_roundtrip(spark, d):
    df = S.pricing(B.flights(spark, d), ["airline"], B.TARGET)
    path = scratch_path(spark, "table-json")
    IO.write_json(df, path)
    return IO.read_json(spark, path, df.schema)


def _load_splits(spark, d):
    df = B.signal(B.flights(spark, d)).select("split", "duration", "days_left", "fare_signal")
    path = scratch_path(spark, "splits")
    IO.write_splits(df, path)
    loaded = IO.load_splits(spark, path, ["train", "val"])
    return loaded.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), half_even(F.avg("fare_signal"), 4).alias("mean_label")
    )


def _lookup(spark, d):
    """Mean log price per destination name, learned on the training rows."""
    t = B.signal(B.flights(spark, d)).select("trip_key", "destination_name", F.log1p("fare").alias("y"), "split")
    train = t.where(F.col("split") == "train")
    means, overall = target_means(train, "destination_name", "y")
    coded = L.lookup_default(t, means, "destination_name", "mean", F.lit(overall), "te")
    return coded.select("trip_key", "destination_name", half_even("te", 8).alias("te"))


def _means(t, label):
    part = t.where(F.col("stopover_label") == label).groupBy("destination_name")
    return part.agg(half_even(F.avg(F.log1p("fare")), 8).alias(f"mean_{label.lower()}"))


def _align_outer(spark, d):
    t = B.flights(spark, d)
    return L.align_outer(_means(t, "A"), _means(t, "R"), "destination_name")


def _scalar_broadcast(spark, d):
    t = B.flights(spark, d).select("trip_key", "fare")
    return L.with_overall_mean(t, "fare", "m").select("trip_key", half_even(F.col("fare") - F.col("m"), 2).alias("diff"))


def _reindex(spark, d):
    t = B.flights(spark, d).groupBy("seasonality").agg(half_even(F.avg("fare"), 4).alias("mean_fare"))
    return L.reindex(t, "seasonality", ["5-LOW", "0-NONE", "1-URGENT"])


def _set_intersect(spark, d):
    stats = materialize(
        B.flights(spark, d).groupBy("airline").agg(F.avg("fare").alias("m"), F.max("fare").alias("x"), F.count("fare").alias("n")),
        "carrier-stats",
    )
    tops = [stats.orderBy(F.desc(c), "airline").limit(10).select("airline") for c in ("m", "x", "n")]
    two = L.set_intersect(*tops[:2]).withColumn("sets", F.lit("mean, max"))
    return two.unionByName(L.set_intersect(*tops).withColumn("sets", F.lit("mean, max, count")))


def _align_columns(spark, d):
    t = B.flights(spark, d).withColumnRenamed("stopovers", "surplus")
    return L.align_columns(t, ["days_left", "airline_unseen", "duration", "departure_hour"], keep=["trip_key"])


def _scalar_math(spark, d):
    x, n = F.col("fare"), F.col("days_left")
    return B.flights(spark, d).select(
        "trip_key",
        half_even(F.log1p(x), 8).alias("log1p"),
        half_even(F.expm1(F.log1p(x)), 4).alias("expm1"),
        F.greatest(n, F.lit(0)).alias("clipped"),
        F.abs(n).alias("abs"),
        half_even(x / 7, 2).alias("rounded"),
        half_even(F.sqrt(x), 8).alias("sqrt"),
    )


def _scalar_string(spark, d):
    return B.gaps(spark, d).select(
        "trip_key",
        F.concat(F.col("airline"), F.lit("_"), F.col("destination")).alias("joined"),
        F.concat_ws(" → ", "source", "destination").alias("label"),
        F.regexp_replace("destination_name", "^Customer#0*", "C").alias("short_name"),
        F.format_number("fare", 0).alias("grouped"),
        F.upper(F.replace(F.col("seasonality"), F.lit("-"), F.lit(" "))).alias("title"),
    )


def _scalar_date(spark, d):
    ts = F.col("ts")
    return B.table(spark, d, "events").select(
        "event_id",
        F.hour(ts).alias("hour"),
        F.weekday(ts).alias("day_of_week"),
        F.month(ts).alias("month"),
        F.date_format(ts, "MMM").alias("month_name"),
        F.date_format(ts, "EEEE").alias("day_name"),
        (K.parse_timestamp(F.date_format(ts, "M/d/yyyy H:mm:ss")) == F.date_trunc("second", ts)).alias("reparsed"),
    )


def queries():
    def cleaned(fn):
        return lambda spark, d: fn(raw(spark, d))

    def renamed(spark, d):
        return K.rename_columns(K.drop_unnamed(raw(spark, d)), RENAME)

    def parsed(spark, d):
        texts = renamed(spark, d).select("departure_datetime", "arrival_datetime", "source")
        return K.parse_timestamps(texts, ["departure_datetime", "arrival_datetime"])

    def imputed(columns, strategy="median"):
        return lambda spark, d: K.impute_missing(
            B.gaps(spark, d).select("trip_key", *columns), strategy
        )

    def report(spark, d):
        before = raw(spark, d)
        out = K.cleaning_report(before, K.clean_flow(before, CONFIG), CONFIG)
        return out.withColumns({c: F.concat_ws(",", c) for c in ("temporal_added", "ordinal_encoded")})

    def stamps(spark, d):
        iso = "yyyy-MM-dd HH:mm:ss"
        return parsed(spark, d).select(
            "source", *[F.date_format(c, iso).alias(c) for c in ("departure_datetime", "arrival_datetime")]
        )

    return {
        "scan_csv": _scan_csv,
        "scan_parquet": _scan_parquet,
        "load_splits": _load_splits,
        "sink_parquet_roundtrip": _parquet_roundtrip,
        "sink_csv_roundtrip": _csv_roundtrip,
        "sink_json_roundtrip": _json_roundtrip,
        "clean_drop_unnamed": cleaned(lambda t: K.drop_unnamed(t.select("Unnamed: 0", "Airline", "Total Fare (BDT)"))),
        "clean_rename": cleaned(lambda t: K.rename_columns(t, {**RENAME, "Absent": "absent"}).drop("Unnamed: 0")),
        "clean_drop_leakage": lambda s, d: K.drop_columns(renamed(s, d), CONFIG.leakage, RENAME),
        "clean_drop_sparse_rows": lambda s, d: K.drop_sparse_rows(
            K.drop_columns(renamed(s, d), CONFIG.leakage, RENAME), 0.5
        ),
        "impute_median": imputed(IMPUTED),
        "impute_mean": lambda s, d: _rounded(imputed(IMPUTED, "mean")(s, d), IMPUTED),
        "impute_categorical": imputed(["airline", "seasonality"]),
        "parse_timestamps": stamps,
        "temporal_features": lambda s, d: K.temporal_features(parsed(s, d), CONFIG.timestamps),
        "ordinal_encode": lambda s, d: K.ordinal_encode(
            B.flights(s, d).select("trip_key", "stopover_label"), "stopover_label", B.STOPOVER_ORDER
        ),
        "unknown_categories": lambda s, d: L.unknown_values(B.gaps(s, d), "seasonality", B.SEASON_ORDER[1:4]),
        "cleaning_report": report,
        "clean_flow": cleaned(lambda t: K.clean_flow(t, CONFIG)),
        "lookup_default": _lookup,
        "align_outer": _align_outer,
        "scalar_broadcast": _scalar_broadcast,
        "reindex": _reindex,
        "set_intersect": _set_intersect,
        "align_columns": _align_columns,
        "sample_n": lambda s, d: L.sample_n(B.flights(s, d).select("trip_key", "fare"), 3000, 42, ["trip_key"]),
        "scalar_math": _scalar_math,
        "scalar_string": _scalar_string,
        "scalar_date": _scalar_date,
    }


def _rounded(df, columns):
    return df.withColumns({c: half_even(c, 6) for c in columns})


def oracles():
    raw_cte = f"WITH {_raw_sql()} "
    shared = summary_oracles()
    split = B.SPLIT_SQL
    renamed = f"(SELECT {_RENAMED} FROM raw)"
    iso = "'%Y-%m-%d %H:%M:%S'"

    def filled(fn: str) -> str:
        def value(c: str) -> str:
            return f"coalesce(CAST({c} AS DOUBLE), (SELECT {fn.format(c=f'CAST({c} AS DOUBLE)')} FROM gaps))"

        return ", ".join(
            f"{value(c) if '0.5' in fn else f'round_even({value(c)}, 6)'} AS {c}" for c in IMPUTED
        )

    temporal = ", ".join(
        f"CAST({fn}({_parsed_sql(s + '_datetime')}){shift} AS INTEGER) AS {s}_{name}"
        for s in ("departure", "arrival")
        for name, fn, shift in (("hour", "hour", ""), ("day_of_week", "isodow", " - 1"), ("month", "month", ""))
    )
    tops = ", ".join(
        f"t_{c} AS (SELECT airline FROM a ORDER BY {c} DESC, airline LIMIT 10)" for c in ("m", "x", "n")
    )
    return {
        "scan_csv": _flights(f"SELECT {', '.join(_SAVED)} FROM flights"),
        "scan_parquet": f"SELECT {', '.join(_LINE)} FROM lineitem WHERE l_quantity > 45 AND l_returnflag = 'R'",
        "load_splits": f"WITH {B.SIGNAL_SQL} SELECT split, count(*) AS rows, round_even(avg(fare_signal), 4) AS mean_label "
        "FROM labelled WHERE split <> 'test' GROUP BY split",
        "sink_parquet_roundtrip": _flights(f"SELECT {', '.join(_SAVED)} FROM flights"),
        "sink_csv_roundtrip": shared["kpi_avg_by_group"],
        "sink_json_roundtrip": shared["pricing_by_group"],
        "clean_drop_unnamed": raw_cte + 'SELECT "Airline", "Total Fare (BDT)" FROM raw',
        "clean_rename": raw_cte + f"SELECT * FROM {renamed}",
        "clean_drop_leakage": raw_cte + f"SELECT {', '.join(_KEPT)} FROM {renamed}",
        "clean_drop_sparse_rows": raw_cte + f"SELECT {', '.join(_KEPT)} FROM {renamed} WHERE {_PRESENT} >= 7",
        "impute_median": _gaps(f"SELECT trip_key, {filled('quantile_cont({c}, 0.5)')} FROM gaps"),
        "impute_mean": _gaps(f"SELECT trip_key, {filled('avg({c})')} FROM gaps"),
        "impute_categorical": _gaps(
            "SELECT trip_key, coalesce(airline, 'Unknown') AS airline, coalesce(seasonality, 'Unknown') AS seasonality FROM gaps"
        ),
        "parse_timestamps": raw_cte
        + f"SELECT source, strftime({_parsed_sql('departure_datetime')}, {iso}) AS departure_datetime, "
        f"strftime({_parsed_sql('arrival_datetime')}, {iso}) AS arrival_datetime FROM {renamed}",
        "temporal_features": raw_cte + f"SELECT source, {temporal} FROM {renamed}",
        "ordinal_encode": _flights("SELECT trip_key, stopovers AS stopover_label FROM flights"),
        "unknown_categories": _gaps(
            "SELECT DISTINCT seasonality FROM gaps WHERE seasonality IS NULL OR seasonality IN ('1-URGENT', '5-LOW')"
        ),
        "cleaning_report": _clean_sql(
            "SELECT initial_rows, CAST(18 AS INTEGER) AS initial_cols, final_rows, CAST(19 AS INTEGER) AS final_cols, "
            "initial_rows - final_rows AS rows_removed, CAST(-1 AS INTEGER) AS cols_removed, "
            "'departure_hour,departure_day_of_week,departure_month,arrival_hour,arrival_day_of_week,arrival_month' AS temporal_added, "
            "'stopovers' AS ordinal_encoded FROM (SELECT (SELECT count(*) FROM raw) AS initial_rows, "
            "(SELECT count(*) FROM cleaned) AS final_rows)"
        ),
        "clean_flow": _clean_sql("SELECT * FROM cleaned"),
        "lookup_default": _flights(
            f", t AS (SELECT *, ln(1 + fare) AS y, {split} AS split FROM flights), m AS (SELECT destination_name AS k, avg(y) AS m FROM t WHERE split = 'train' GROUP BY 1) "
            "SELECT trip_key, destination_name, round_even(coalesce(m, (SELECT avg(y) FROM t WHERE split = 'train')), 8) AS te "
            "FROM t LEFT JOIN m ON destination_name = k"
        ),
        "align_outer": _flights(
            "SELECT coalesce(a.k, b.k) AS destination_name, mean_a, mean_r FROM "
            "(SELECT destination_name AS k, round_even(avg(ln(1 + fare)), 8) AS mean_a FROM flights WHERE stopover_label = 'A' GROUP BY 1) a FULL JOIN "
            "(SELECT destination_name AS k, round_even(avg(ln(1 + fare)), 8) AS mean_r FROM flights WHERE stopover_label = 'R' GROUP BY 1) b ON a.k = b.k"
        ),
        "scalar_broadcast": _flights(
            "SELECT trip_key, round_even(fare - (SELECT avg(fare) FROM flights), 2) AS diff FROM flights"
        ),
        "reindex": _flights(
            "SELECT position, w.s AS seasonality, m AS mean_fare FROM (VALUES (0, '5-LOW'), (1, '0-NONE'), (2, '1-URGENT')) w(position, s) "
            "LEFT JOIN (SELECT seasonality AS s, round_even(avg(fare), 4) AS m FROM flights GROUP BY 1) q ON w.s = q.s"
        ),
        "set_intersect": _flights(
            f", a AS (SELECT airline, avg(fare) AS m, max(fare) AS x, count(fare) AS n FROM flights GROUP BY 1), {tops} "
            "SELECT airline, 'mean, max' AS sets FROM (SELECT * FROM t_m INTERSECT SELECT * FROM t_x) UNION ALL "
            "SELECT airline, 'mean, max, count' AS sets FROM (SELECT * FROM t_m INTERSECT SELECT * FROM t_x INTERSECT SELECT * FROM t_n)"
        ),
        "align_columns": _flights(
            "SELECT trip_key, days_left, CAST(0 AS INTEGER) AS airline_unseen, duration, departure_hour FROM flights"
        ),
        "sample_n": _flights("SELECT trip_key, fare FROM flights ORDER BY md5(trip_key || '|42') LIMIT 3000"),
        "scalar_math": _flights(
            "SELECT trip_key, round_even(ln(1 + fare), 8) AS log1p, round_even(exp(ln(1 + fare)) - 1, 4) AS expm1, "
            "greatest(days_left, 0) AS clipped, abs(days_left) AS abs, round_even(fare / 7, 2) AS rounded, "
            "round_even(sqrt(fare), 8) AS sqrt FROM flights"
        ),
        "scalar_string": _gaps(
            "SELECT trip_key, airline || '_' || destination AS joined, concat_ws(' → ', source, destination) AS label, "
            "regexp_replace(destination_name, '^Customer#0*', 'C') AS short_name, format('{:,.0f}', fare) AS grouped, "
            "upper(replace(seasonality, '-', ' ')) AS title FROM gaps"
        ),
        "scalar_date": "SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(isodow(ts) - 1 AS INTEGER) AS day_of_week, "
        "CAST(month(ts) AS INTEGER) AS month, strftime(ts, '%b') AS month_name, strftime(ts, '%A') AS day_name, "
        "true AS reparsed FROM events",
    }


