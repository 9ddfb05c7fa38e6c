"""Table profiling and data-quality checks. All columns share a scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.dates import looks_like_timestamp
from tabforge.functions.numeric import half_even, not_nan, percent
from tabforge.operators.quantiles import column_stats

QUARTILES = {"p25": 0.25, "median": 0.5, "p75": 0.75}


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def string_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def missing(c: str, dtype: T.DataType) -> Column:
    x = F.col(c)
    return (x.isNull() | F.isnan(x)) if isinstance(dtype, (T.DoubleType, T.FloatType)) else x.isNull()


def _entries(row: DataFrame, entries: list[Column]) -> DataFrame:
    """One output row per struct of a one-row aggregate."""
    return row.select(F.explode(F.array(*entries)).alias("e")).select("e.*")


def structure(df: DataFrame) -> DataFrame:
    """Per column: position, type, non-missing and missing count; the row count beside them."""
    nulls = [F.count_if(missing(f.name, f.dataType)).alias(f"n{i}") for i, f in enumerate(df.schema)]
    row = df.agg(F.count(F.lit(1)).alias("rows"), *nulls)
    return _entries(
        row,
        [
            F.struct(
                F.lit(i).alias("position"),
                F.lit(f.name).alias("column"),
                F.lit(f.dataType.simpleString()).alias("dtype"),
                (F.col("rows") - F.col(f"n{i}")).alias("non_null"),
                F.col(f"n{i}").alias("nulls"),
                F.col("rows").alias("rows"),
            )
            for i, f in enumerate(df.schema)
        ],
    )


def missing_audit(df: DataFrame) -> DataFrame:
    """Missing count and share of the columns that have any; ``total_missing`` sums them up."""
    rows = structure(df)
    total = F.col("nulls") > 0
    return rows.where(total).select(
        "column",
        F.col("nulls").alias("missing_count"),
        half_even(percent(F.col("nulls"), F.col("rows")), 2).alias("missing_pct"),
    )


def total_missing(df: DataFrame) -> DataFrame:
    return structure(df).agg(F.sum("nulls").alias("missing_cells"))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row. Copies collapse before the shuffle, so a hot row is cheap."""
    copies = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    total = F.sum("_n")
    extra = F.coalesce(total - F.count(F.lit(1)), F.lit(0))
    return copies.agg(extra.alias("duplicate_rows"), half_even(percent(extra, total), 2).alias("duplicate_pct"))


def describe_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    cols = columns or numeric_columns(df)
    stats = column_stats(df, cols, QUARTILES, ("mean", "std", "min", "max"))
    names = ["mean", "std", "min", "p25", "median", "p75", "max"]
    return stats.select("column", "count", *[half_even(n, 2).alias(n) for n in names])


def value_cells(df: DataFrame, columns: list[str]) -> DataFrame:
    """Count of every distinct non-missing value of each column, values as text."""
    text = df.select(*[F.col(c).cast("string").alias(c) for c in columns])
    long = text.unpivot([], columns, "column", "value").where(F.col("value").isNotNull())
    return long.groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))


def categorical_profile(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Number of values, most frequent value (ties: smallest) and its count, per column."""
    cells = value_cells(df, columns or string_columns(df))
    best = F.min(F.struct((-F.col("count")).alias("n"), "value"))
    return cells.groupBy("column").agg(
        F.sum("count").alias("count"),
        F.count(F.lit(1)).alias("unique"),
        best["value"].alias("top"),
        (-best["n"]).alias("freq"),
    )


def describe_all(df: DataFrame, numeric: list[str], categorical: list[str]) -> DataFrame:
    """Numeric and categorical descriptions in one table; what does not apply is NULL."""
    return describe_numeric(df, numeric).unionByName(
        categorical_profile(df, categorical), allowMissingColumns=True
    )


def numeric_profile(df: DataFrame, columns: list[str]) -> DataFrame:
    stats = column_stats(df, columns, {}, ("min", "max", "skew"))
    return stats.select("column", *[half_even(n, d).alias(n) for n, d in (("min", 2), ("max", 2), ("skew", 4))])


def iqr_outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values strictly outside ``[q1 - 1.5 iqr, q3 + 1.5 iqr]``, per column.

    The two fences per column are collected as numbers and tested in one more scan.
    """
    q1, q3 = F.col("p25"), F.col("p75")
    stats = column_stats(df, columns, {"p25": 0.25, "p75": 0.75}, ())
    fences = {
        r["column"]: (r["low"], r["high"])
        for r in stats.select(
            "column", (q1 - 1.5 * (q3 - q1)).alias("low"), (q3 + 1.5 * (q3 - q1)).alias("high")
        ).collect()
    }
    aggs = []
    for c in columns:
        low, high = fences.setdefault(c, (None, None))  # a table without rows has no fences
        x = not_nan(c)
        outside = (x < F.lit(low).cast("double")) | (x > F.lit(high).cast("double"))
        aggs += [F.count_if(outside).alias(f"o_{c}"), F.count(x).alias(f"n_{c}")]
    return _entries(
        df.agg(*aggs),
        [
            F.struct(
                F.lit(c).alias("column"),
                half_even(F.lit(fences[c][0]).cast("double"), 4).alias("lower"),
                half_even(F.lit(fences[c][1]).cast("double"), 4).alias("upper"),
                F.col(f"o_{c}").alias("outliers"),
                half_even(percent(F.col(f"o_{c}"), F.col(f"n_{c}")), 2).alias("outlier_pct"),
            )
            for c in columns
        ],
    )


def target_summary(df: DataFrame, target: str) -> DataFrame:
    stats = column_stats(df, [target], {"median": 0.5}, ("min", "max", "mean"))
    return stats.select(
        F.col("column").alias("target"), *[half_even(n, 2).alias(n) for n in ("min", "max", "mean", "median")]
    )


def value_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    return value_cells(df, columns).orderBy("column", F.desc("count"), "value")


def column_cardinality(df: DataFrame, columns: list[str]) -> DataFrame:
    """Type, number of distinct values and the smallest value (as text) as a stable sample."""
    types = {f.name: f.dataType.simpleString() for f in df.schema}
    dtype = F.create_map(*[x for c in columns for x in (F.lit(c), F.lit(types[c]))])[F.col("column")]
    rows = value_cells(df, columns).groupBy("column").agg(
        F.count(F.lit(1)).alias("n_unique"), F.min("value").alias("sample")
    )
    return rows.withColumn("dtype", dtype)


def timestamp_like(df: DataFrame) -> list[str]:
    """String columns whose non-missing values all parse as timestamps, from one scan of all values.

    A column without values counts as one, and plain numbers do not.
    """
    columns = string_columns(df)
    if not columns:
        return []
    bad = [F.count_if(F.col(f"`{c}`").isNotNull() & ~looks_like_timestamp(F.col(f"`{c}`"))).alias(f"b{i}") for i, c in enumerate(columns)]
    row = df.agg(*bad).first()
    return [c for i, c in enumerate(columns) if not row[f"b{i}"]]


def detect_timestamps(df: DataFrame) -> DataFrame:
    hits = set(timestamp_like(df))
    rows = [(c, c in hits) for c in string_columns(df)]
    return df.sparkSession.createDataFrame(rows, "column string, is_timestamp boolean")


def classify_columns(df: DataFrame) -> DataFrame:
    """Each column as numerical, categorical or datetime."""
    hits = set(timestamp_like(df))
    rows = []
    for f in df.schema:
        if isinstance(f.dataType, T.NumericType):
            rows.append((f.name, "numerical"))
        elif isinstance(f.dataType, T.StringType):
            rows.append((f.name, "datetime" if f.name in hits else "categorical"))
        elif isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            rows.append((f.name, "datetime"))
    return df.sparkSession.createDataFrame(rows, "column string, kind string")
