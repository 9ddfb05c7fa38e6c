"""Binding of the analytics columns to the star-schema test tables.

``trips`` has one row per ``lineitem`` row, in Spark and, for the oracle, as a
SQL common table expression with the same columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tabforge.functions.hashing import bucket
from tabforge.session import materialize, setting
from tabforge.sources.tables import read_parquet

TARGET = "fare"
CATEGORICAL = [
    "airline",
    "source",
    "destination",
    "aircraft_type",
    "travel_class",
    "booking_source",
    "seasonality",
]
# The categories of the feature flow with the values that the test tables can hold.
WORDS = {
    "airline": [f"Brand#{i}" for i in range(1, 26)],
    "source": [f"NATION_{i}" for i in range(25)],
    "destination": [f"NATION_{i}" for i in range(25)],
    "aircraft_type": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"],
    "travel_class": ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"],
    "booking_source": ["F", "O", "P"],
    "seasonality": ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"],
}
CATEGORIES = tuple(WORDS)
NUMERICAL = [
    "duration",
    "days_left",
    "stopovers",
    "departure_hour",
    "departure_day_of_week",
    "departure_month",
    "arrival_hour",
    "arrival_day_of_week",
    "arrival_month",
]
STOPOVER_ORDER = ["A", "N", "R"]
SEASON_ORDER = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
BASELINE_SEASON = "5-LOW"
CLASS_EFFECT = {"BUILDING": 2000.0, "FURNITURE": 4000.0, "HOUSEHOLD": 6000.0, "MACHINERY": 8000.0}


# Declared schemas: a scan then starts without a job that reads file footers.
SCHEMAS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
    "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
    "l_shipdate timestamp_ntz",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return read_parquet(spark, f"{sf_dir}/{name}.parquet", SCHEMAS[name])


def booked_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders with their customers, stored."""
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    joined = orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
    kept = ("o_orderkey", "o_orderdate", "o_orderstatus", "o_orderpriority", "c_name", "c_nationkey", "c_mktsegment")
    return materialize(joined.select(*kept), "orders")


def joined_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys, categories, numbers and the two timestamps, joined from the star schema.

    Joins carry no hints: the dimension tables are broadcast when their size
    allows it and shuffled otherwise. The customers are joined to the orders,
    which are stored so that their size is known: the many more lines are never
    moved by the key of a customer, and names of nations are added at the end.
    Parts come first, as they add least to a line that still has to move.
    """
    line, supplier, part, nation = (table(spark, sf_dir, n) for n in ("lineitem", "supplier", "part", "nation"))
    origin = nation.select(F.col("n_nationkey").alias("_sn"), F.col("n_name").alias("source"))
    goal = nation.select(F.col("n_nationkey").alias("_cn"), F.col("n_name").alias("destination"))
    joined = (
        line.join(part, F.col("l_partkey") == F.col("p_partkey"))
        .join(booked_orders(spark, sf_dir), F.col("l_orderkey") == F.col("o_orderkey"))
        .join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(origin, F.col("s_nationkey") == F.col("_sn"))
        .join(goal, F.col("c_nationkey") == F.col("_cn"))
    )
    hour = (F.col("l_partkey") % 24).cast("int")

    def shifted(hours: Column) -> Column:
        return F.col("l_shipdate") + F.make_dt_interval(F.lit(0), hours)

    return joined.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("trip_key"),
        F.col("l_orderkey").alias("split_key"),
        F.col("p_brand").alias("airline"),
        "source",
        F.col("s_name").alias("source_name"),
        "destination",
        F.col("c_name").alias("destination_name"),
        F.col("l_returnflag").alias("stopover_label"),
        F.col("p_type").alias("aircraft_type"),
        F.col("c_mktsegment").alias("travel_class"),
        F.col("o_orderstatus").alias("booking_source"),
        F.col("o_orderpriority").alias("seasonality"),
        F.col("l_quantity").alias("duration"),
        F.datediff("l_shipdate", "o_orderdate").cast("bigint").alias("days_left"),
        shifted(hour).alias("departure_datetime"),
        shifted((F.col("l_partkey") % 24 + F.col("l_quantity")).cast("int")).alias("arrival_datetime"),
        F.col("l_extendedprice").alias("fare"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("base_fare"),
        (F.col("l_extendedprice") * F.col("l_discount")).alias("tax_surcharge"),
        F.col("l_linenumber").alias("line_no"),
        F.col("l_partkey").alias("part_no"),
    )


def build_flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``joined_trips`` with ordinal stopovers and integer temporal parts."""
    t = joined_trips(spark, sf_dir)
    parts: dict[str, Column] = {}
    for side in ("departure", "arrival"):
        ts = F.col(f"{side}_datetime")
        parts[f"{side}_hour"] = F.hour(ts)
        parts[f"{side}_day_of_week"] = F.weekday(ts)
        parts[f"{side}_month"] = F.month(ts)
    codes = F.array_position(F.array(*map(F.lit, STOPOVER_ORDER)), F.col("stopover_label"))
    return t.withColumns({"stopovers": (codes - 1).cast("int"), **parts})


LINES = 250_000  # that a task of the joins sorts


def join_tasks(lines: DataFrame):
    """Shuffles inside the block have tasks in proportion to the ``lines``, or as many as are set, whichever is more."""
    name = "spark.sql.shuffle.partitions"
    return setting(lines.sparkSession, name, max(int(lines.sparkSession.conf.get(name)), -(-lines.count() // LINES)))


_stored: dict[tuple[str, str], DataFrame] = {}
ROW_GROUP = 4 * 2**20  # bytes; small, as most analyses read few of the columns


def flights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The processed table, stored once per session and data folder.

    Later stages read the cleaned table from parquet instead of repeating the
    joins: every analysis then scans only the columns it names, in as many
    tasks as there are row groups.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _stored:
        with join_tasks(table(spark, sf_dir, "lineitem")):
            _stored[key] = materialize(build_flights(spark, sf_dir), "processed", row_group=ROW_GROUP)
    return _stored[key]


def gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``flights`` with missing values in five columns."""
    f = flights(spark, sf_dir)
    holes = {
        "duration": F.col("part_no") % 11 == 0,
        "days_left": F.col("line_no") == 3,
        "airline": F.col("part_no") % 13 == 0,
        "seasonality": F.col("line_no") == 5,
        "fare": F.col("part_no") % 17 == 0,
    }
    return f.withColumns({c: F.when(~hole, F.col(c)) for c, hole in holes.items()})


def split_of(key: Column | str, seed: int = 42) -> Column:
    b = bucket(key, seed)
    return F.when(b < 700, "train").when(b < 800, "val").otherwise("test")


def signal(df: DataFrame) -> DataFrame:
    """Adds ``fare_signal``, a label the features do explain, and ``split``."""
    effect = F.lit(0.0)
    for name, value in CLASS_EFFECT.items():
        effect = effect + F.when(F.col("travel_class") == name, value).otherwise(0.0)
    noise = (bucket("trip_key", "sig") - 500) * 4.0
    return df.withColumns(
        {
            "fare_signal": F.lit(5000.0)
            + 300.0 * F.col("duration")
            + effect
            + F.when(F.col("booking_source") == "P", 4000.0).otherwise(0.0)
            + noise,
            "split": split_of("split_key"),
        }
    )


TRIPS_SQL = """
trips AS (
  SELECT concat_ws('-', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR),
                   CAST(l_partkey AS VARCHAR), CAST(l_suppkey AS VARCHAR)) AS trip_key,
         l_orderkey AS split_key, p_brand AS airline, sn.n_name AS source, s_name AS source_name,
         cn.n_name AS destination, c_name AS destination_name, l_returnflag AS stopover_label,
         p_type AS aircraft_type, c_mktsegment AS travel_class, o_orderstatus AS booking_source,
         o_orderpriority AS seasonality, l_quantity AS duration,
         CAST(datediff('day', o_orderdate, l_shipdate) AS BIGINT) AS days_left,
         l_shipdate + to_hours(CAST(l_partkey % 24 AS INTEGER)) AS departure_datetime,
         l_shipdate + to_hours(CAST(l_partkey % 24 + l_quantity AS INTEGER)) AS arrival_datetime,
         l_extendedprice AS fare, l_extendedprice * (1 - l_discount) AS base_fare,
         l_extendedprice * l_discount AS tax_surcharge,
         l_linenumber AS line_no, l_partkey AS part_no
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN part ON l_partkey = p_partkey JOIN nation sn ON s_nationkey = sn.n_nationkey
  JOIN nation cn ON c_nationkey = cn.n_nationkey
)"""

FLIGHTS_SQL = (
    TRIPS_SQL
    + """,
flights AS (
  SELECT *, CAST(list_position(['A','N','R'], stopover_label) - 1 AS INTEGER) AS stopovers,
         CAST(hour(departure_datetime) AS INTEGER) AS departure_hour,
         CAST(isodow(departure_datetime) - 1 AS INTEGER) AS departure_day_of_week,
         CAST(month(departure_datetime) AS INTEGER) AS departure_month,
         CAST(hour(arrival_datetime) AS INTEGER) AS arrival_hour,
         CAST(isodow(arrival_datetime) - 1 AS INTEGER) AS arrival_day_of_week,
         CAST(month(arrival_datetime) AS INTEGER) AS arrival_month
  FROM trips
)"""
)


GAPS_SQL = (
    FLIGHTS_SQL
    + """,
gaps AS (
  SELECT * REPLACE (
    CASE WHEN part_no % 11 <> 0 THEN duration END AS duration,
    CASE WHEN line_no <> 3 THEN days_left END AS days_left,
    CASE WHEN part_no % 13 <> 0 THEN airline END AS airline,
    CASE WHEN line_no <> 5 THEN seasonality END AS seasonality,
    CASE WHEN part_no % 17 <> 0 THEN fare END AS fare)
  FROM flights
)"""
)


def bucket_sql(key: str, salt: str, buckets: int = 1000) -> str:
    return f"CAST('0x' || substr(md5(CAST({key} AS VARCHAR) || ':{salt}'), 1, 8) AS BIGINT) % {buckets}"


SPLIT_SQL = (
    f"CASE WHEN {bucket_sql('split_key', '42')} < 700 THEN 'train' "
    f"WHEN {bucket_sql('split_key', '42')} < 800 THEN 'val' ELSE 'test' END"
)

SIGNAL_SQL = (
    FLIGHTS_SQL
    + f""",
labelled AS (
  SELECT *, 5000.0 + 300.0 * duration
         + CASE travel_class WHEN 'BUILDING' THEN 2000.0 WHEN 'FURNITURE' THEN 4000.0
                WHEN 'HOUSEHOLD' THEN 6000.0 WHEN 'MACHINERY' THEN 8000.0 ELSE 0.0 END
         + CASE WHEN booking_source = 'P' THEN 4000.0 ELSE 0.0 END
         + ({bucket_sql("trip_key", "sig")} - 500) * 4.0 AS fare_signal,
         {SPLIT_SQL} AS split
  FROM flights
)"""
)
