"""Queries and oracles: feature engineering."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tabforge.functions.numeric import half_even
from tabforge.operators import cleaning as K
from tabforge.operators import features as X
from tabforge.operators.digests import compare_tables, table_digest
from tabforge.operators.lookups import align_columns, lookup_default
from tabforge.plans import trips as B
from tabforge.session import scratch_path
from tabforge.sources import tables as IO

CONFIG = X.FeatureConfig(
    target="fare",
    categorical=B.CATEGORIES,
    numerical=tuple(B.NUMERICAL),
    split_key="split_key",
    redundant=("source_name", "destination_name"),
    target_encode=("route",),
    log_target=True,
    log_numeric=("duration", "days_left"),
)
SCALED = ["duration", "days_left", "stopovers"]
WORDS = B.WORDS
HOT = sorted(f"{c}_{v}" for c, values in WORDS.items() for v in values)


def _model(spark, d):
    return X.fit_features(B.flights(spark, d), CONFIG)


def aligned(rows, keep):
    """Feature columns for all values that can occur: a small table need not hold each of them."""
    return align_columns(rows, sorted([*HOT, *B.NUMERICAL, "route_te"]), keep)


def _feature_set(spark, d):
    rows = X.feature_set(B.flights(spark, d), _model(spark, d), ("trip_key",))
    return aligned(rows, ["trip_key", "split", "label"])


def _rounded(df):
    numbers = [c for c, t in df.dtypes if t == "double"]
    return df.select(*[half_even(f"`{c}`", 6).alias(c) if c in numbers else F.col(f"`{c}`") for c in df.columns])


def _standardize(spark, d):
    rows = X.labelled(B.flights(spark, d), CONFIG).select("trip_key", "split", *SCALED)
    state = X.scaler_state(rows.where("split = 'train'"), SCALED)
    return _rounded(X.standardize(rows, state))


def _encoded(spark, d):
    rows = X.interaction(X.labelled(B.flights(spark, d), CONFIG), "source", "destination", "route")
    rows = rows.select("trip_key", "split", "label", "route")
    train = rows.where("split = 'train'")
    means, overall = X.target_means(train, "route", "label")
    out = lookup_default(rows, means, "route", "mean", F.lit(overall), "route_te")
    return _rounded(out.drop("route", "label"))


def _te_top(spark, d):
    rows = X.interaction(X.labelled(B.flights(spark, d), CONFIG), "source", "destination", "route")
    means, _ = X.target_means(rows.where("split = 'train'"), "route", "label")
    top = means.orderBy(F.desc("mean"), "route").limit(5)
    return top.select("route", half_even("mean", 4).alias("mean"), half_even(F.expm1("mean")).alias("price"))


def _scaled_stats(spark, d):
    train = _feature_set(spark, d).where("split = 'train'")
    long = train.select(*B.NUMERICAL).unpivot([], B.NUMERICAL, "feature", "v")
    return long.groupBy("feature").agg(
        F.abs(half_even(F.avg("v"), 6)).alias("abs_mean"), half_even(F.stddev_pop("v"), 6).alias("std")
    )


def _roundtrip(spark, d):
    """Feature set and fitted state written, reloaded and applied to the test split."""
    flights = B.flights(spark, d)
    model = _model(spark, d)
    data, state = scratch_path(spark, "features"), scratch_path(spark, "feature-model")
    IO.write_splits(aligned(X.feature_set(flights, model, ("trip_key",)), ["trip_key", "split", "label"]), data)
    model.save(spark, state)
    again = X.FeatureModel.load(spark, state)
    loaded = IO.load_splits(spark, data, ["train", "val"])
    rebuilt = aligned(X.feature_set(flights, again, ("trip_key",)).where("split = 'test'"), ["trip_key", "split", "label"])
    return _rounded(loaded.unionByName(rebuilt))


def _vector(spark, d):
    """The places of the ones among the one-hot features of each row, and the number of features."""
    rows = X.labelled(B.flights(spark, d), CONFIG)
    model = _model(spark, d)
    out = model.transform(rows).select("trip_key", "split", half_even("label", 6).alias("label"), vector_to_array("features").alias("f"))
    n_hot = sum(model.vocabulary.sizes.values())
    ones = F.filter(F.sequence(F.lit(0), F.lit(n_hot - 1)), lambda i: F.get("f", i) == 1.0)
    return out.select("trip_key", "split", "label", F.array_join(ones.cast("array<string>"), ",").alias("hot"), F.size("f").alias("n_features"))


DIGESTED = ["trip_key", "source", "days_left", "departure_hour"]


def _split_digests(spark, d):
    """Numbers of rows and digests of the splits: disjoint ones add up to the whole table."""
    rows = X.labelled(B.flights(spark, d), CONFIG)
    return table_digest(rows, DIGESTED, ["split"], portable=True)


def _roundtrip_digest(spark, d):
    """Whether each split comes back from its files as it was."""
    rows = X.labelled(B.flights(spark, d), CONFIG).select("split", *DIGESTED, "fare", "label")
    path = scratch_path(spark, "digest-splits")
    IO.write_splits(rows, path)
    return compare_tables(rows, IO.load_splits(spark, path, ["train", "val", "test"]))


def _wide(spark, d):
    rows = X.one_hot_wide(B.gaps(spark, d).select("trip_key", *WORDS, "fare"), list(WORDS), "fare")
    return align_columns(rows, HOT, ["trip_key", "fare"])


def queries():
    return {
        "feat_drop_redundant": lambda s, d: K.drop_columns(
            B.flights(s, d).select("trip_key", "source", "source_name", "destination_name"), CONFIG.redundant
        ),
        "feat_interaction": lambda s, d: X.interaction(
            B.gaps(s, d).select("trip_key", "airline", "destination"), "airline", "destination", "route"
        ),
        "feat_onehot_wide": _wide,
        "feat_onehot_vector": _vector,
        "split_digests": _split_digests,
        "roundtrip_digest": _roundtrip_digest,
        "feat_log_target": lambda s, d: B.flights(s, d).select(
            "trip_key", half_even(F.log1p("fare"), 8).alias("label")
        ),
        "feat_split": lambda s, d: X.labelled(B.flights(s, d), CONFIG).select("trip_key", "split"),
        "feat_log_numeric": lambda s, d: _rounded(
            X.log_numeric(B.gaps(s, d).select("trip_key", "duration", "days_left"), ["duration", "days_left"])
        ),
        "feat_target_encode": _encoded,
        "feat_standardize": _standardize,
        "feature_flow": lambda s, d: _rounded(_feature_set(s, d)),
        "feature_set_roundtrip": _roundtrip,
        "scaler_params": lambda s, d: _model(s, d).scaler_table(s),
        "scaled_stats": _scaled_stats,
        "te_top_categories": _te_top,
        "split_report": lambda s, d: X.split_report(X.labelled(B.flights(s, d), CONFIG)),
    }


ROWS_SQL = (
    B.FLIGHTS_SQL
    + f""",
rows AS (SELECT * EXCLUDE (duration, days_left), {B.SPLIT_SQL} AS split, ln(1 + fare) AS label,
         source || '_' || destination AS route, duration AS raw_duration, days_left AS raw_days,
         ln(1 + greatest(duration, 0)) AS duration, ln(1 + greatest(days_left, 0)) AS days_left FROM flights),
te AS (SELECT route AS k, avg(label) AS m FROM rows WHERE split = 'train' GROUP BY 1)"""
)


def _hot(prefix: str = "") -> str:
    return ", ".join(
        f"CASE WHEN {prefix}{c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, vs in WORDS.items() for v in vs
    )


def _scaled(c: str, table: str = "rows") -> str:
    at = f"FROM {table} WHERE split = 'train'"
    return f"round_even(({c} - (SELECT avg({c}) {at})) / (SELECT stddev_pop({c}) {at}), 6) AS {c}"


def flow_sql(where: str = "") -> str:
    numbers = ", ".join(_scaled(c) for c in B.NUMERICAL)
    return (
        f"SELECT trip_key, split, round_even(label, 6) AS label, {numbers}, "
        f"round_even(coalesce(m, (SELECT avg(label) FROM rows WHERE split = 'train')), 6) AS route_te, {_hot()} "
        f"FROM rows LEFT JOIN te ON route = k {where}"
    )


def _vector_sql() -> str:
    """The index of a value is its place among the values of its column, after those of the columns before."""
    ctes, before = [], "0"
    for c in WORDS:
        ctes.append(f"v_{c} AS (SELECT v, row_number() OVER (ORDER BY v) - 1 + {before} AS at FROM (SELECT DISTINCT {c} AS v FROM rows WHERE {c} IS NOT NULL))")
        before = f"{before} + (SELECT count(*) FROM v_{c})"
    joins = " ".join(f"LEFT JOIN v_{c} ON rows.{c} = v_{c}.v" for c in WORDS)
    places = ", ".join(f"v_{c}.at" for c in WORDS)
    return (
        f", {', '.join(ctes)} SELECT trip_key, split, round_even(label, 6) AS label, concat_ws(',', {places}) AS hot, "
        f"CAST({before} + {len(B.NUMERICAL) + 1} AS INTEGER) AS n_features FROM rows {joins}"
    )


def _hash_sql(columns: list[str]) -> str:
    text = " || '|' || ".join(f"coalesce('=' || CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT)"


def oracles():
    rows = f"WITH {ROWS_SQL}"
    vectors = rows + _vector_sql()
    rows += " "
    flights = f"WITH {B.FLIGHTS_SQL} "
    gaps = f"WITH {B.GAPS_SQL} "
    params = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round_even(avg({c}), 4) AS mean, round_even(stddev_pop({c}), 4) AS scale FROM rows WHERE split = 'train'"
        for c in B.NUMERICAL
    )
    stats = " UNION ALL ".join(f"SELECT '{c}' AS feature, 0.0::DOUBLE AS abs_mean, round_even(stddev_pop(({c} - m) / s), 6) AS std "
        f"FROM rows, (SELECT avg({c}) AS m, stddev_pop({c}) AS s FROM rows WHERE split = 'train') WHERE split = 'train'" for c in B.NUMERICAL)
    split = f", t AS (SELECT *, {B.SPLIT_SQL} AS split FROM flights) "
    raw_scaled = ", ".join(_scaled(c, "t") for c in SCALED)
    return {
        "feat_drop_redundant": flights + "SELECT trip_key, source FROM flights",
        "feat_interaction": gaps + "SELECT trip_key, airline, destination, airline || '_' || destination AS route FROM gaps",
        "feat_onehot_wide": gaps + f"SELECT trip_key, {_hot()}, fare FROM gaps",
        "feat_onehot_vector": vectors,
        "split_digests": rows + "SELECT split, c AS \"column\", count(*) AS rows, CAST(sum(h) % 4503599627370496 AS BIGINT) AS total, bit_xor(h) AS parity FROM ("
        + " UNION ALL ".join(f"SELECT split, '{name}' AS c, {_hash_sql(cs)} AS h FROM (SELECT * EXCLUDE (days_left), raw_days AS days_left FROM rows)" for name, cs in [*[(c, [c]) for c in DIGESTED], ("row", DIGESTED)])
        + ") GROUP BY split, c",
        "roundtrip_digest": flights + "SELECT c AS \"column\", (SELECT count(*) FROM flights) AS rows, (SELECT count(*) FROM flights) AS other_rows, true AS same FROM (VALUES "
        + ", ".join(f"('{c}')" for c in ["split", *DIGESTED, "fare", "label", "row"]) + ") t(c)",
        "feat_log_target": flights + "SELECT trip_key, round_even(ln(1 + fare), 8) AS label FROM flights",
        "feat_split": flights + f"SELECT trip_key, {B.SPLIT_SQL} AS split FROM flights",
        "feat_log_numeric": gaps
        + "SELECT trip_key, round_even(ln(1 + CASE WHEN duration > 0 THEN duration WHEN duration <= 0 THEN 0 END), 6) AS duration, "
        "round_even(ln(1 + CASE WHEN days_left > 0 THEN days_left WHEN days_left <= 0 THEN 0 END), 6) AS days_left FROM gaps",
        "feat_target_encode": rows
        + "SELECT trip_key, split, round_even(coalesce(m, (SELECT avg(label) FROM rows WHERE split = 'train')), 6) AS route_te "
        "FROM rows LEFT JOIN te ON route = k",
        "feat_standardize": flights + split + f"SELECT trip_key, split, {raw_scaled} FROM t",
        "feature_flow": rows + flow_sql(),
        "feature_set_roundtrip": rows + flow_sql(""),
        "scaler_params": rows + params,
        "scaled_stats": rows + stats,
        "te_top_categories": rows
        + "SELECT k AS route, round_even(m, 4) AS mean, round_even(exp(m) - 1, 0) AS price FROM te ORDER BY m DESC, k LIMIT 5",
        "split_report": rows
        + "SELECT split, count(*) AS rows, round_even(count(*) * 100.0 / (SELECT count(*) FROM rows), 2) AS share_pct, "
        "round_even(min(label), 4) AS min, round_even(quantile_cont(label, 0.5), 4) AS median, "
        "round_even(max(label), 4) AS max FROM rows GROUP BY split",
    }
