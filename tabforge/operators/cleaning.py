"""Cleaning steps and the whole cleaning flow."""

from __future__ import annotations

import re
import warnings
from dataclasses import dataclass, field
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.dates import calendar_part, parse_timestamp
from tabforge.functions.numeric import not_nan
from tabforge.operators.profiling import numeric_columns, string_columns, structure
from tabforge.operators.quantiles import column_stats

PARTS = ("hour", "day_of_week", "month")


@dataclass(frozen=True)
class CleaningConfig:
    """Column roles and parameters of the cleaning flow.

    ``leakage`` may use raw or renamed names. ``on_unknown`` says what happens
    to text that is no timestamp or no known category: ``error`` or ``null``.
    """

    rename: dict[str, str] = field(default_factory=dict)
    leakage: tuple[str, ...] = ()
    missing_threshold: float = 0.5
    numeric_strategy: str = "median"
    categorical_fill: str = "Unknown"
    timestamps: tuple[str, ...] = ("departure_datetime", "arrival_datetime")
    ordinal: dict[str, tuple[str, ...]] = field(default_factory=dict)
    on_unknown: str = "error"


def drop_unnamed(df: DataFrame) -> DataFrame:
    return df.drop(*[c for c in df.columns if re.match("unnamed", c, re.IGNORECASE)])


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed({old: new for old, new in names.items() if old in df.columns})


def drop_columns(df: DataFrame, columns: list[str] | tuple[str, ...], rename: dict[str, str] | None = None) -> DataFrame:
    """Drops the named columns that exist, after mapping raw names through ``rename``."""
    return df.drop(*[(rename or {}).get(c, c) for c in columns])


def drop_sparse_rows(df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Keeps rows with at least ``floor(columns * (1 - threshold))`` present cells."""
    return df.dropna(thresh=int(len(df.columns) * (1.0 - threshold)))


def imputation_values(df: DataFrame, strategy: str = "median") -> dict[str, float]:
    """Exact median or mean of the numeric columns that have missing values."""
    if strategy not in ("median", "mean"):
        raise ValueError(f"unknown strategy {strategy!r}")
    numeric = numeric_columns(df)
    if not numeric:
        return {}
    gaps = [r["column"] for r in structure(df.select(*numeric)).where("nulls > 0").collect()]
    if not gaps:
        return {}
    quantiles = {"median": 0.5} if strategy == "median" else {}
    stats = column_stats(df, gaps, quantiles, ("mean",)).collect()
    return {r["column"]: r[strategy] for r in stats if r[strategy] is not None}


def impute_missing(
    df: DataFrame, strategy: str = "median", fill: str = "Unknown", values: dict[str, float] | None = None
) -> DataFrame:
    """Fills numeric gaps with the learned ``values`` and text gaps with ``fill``.

    An integer column with gaps becomes double, since its median need not be whole.
    """
    learned = imputation_values(df, strategy) if values is None else values
    filled: dict[str, Column] = {
        c: F.coalesce(not_nan(c), F.lit(v)) for c, v in learned.items() if c in df.columns
    }
    filled |= {c: F.coalesce(F.col(c), F.lit(fill)) for c in string_columns(df)}
    return df.withColumns(filled) if filled else df


def parse_timestamps(df: DataFrame, columns: tuple[str, ...] | list[str], on_unknown: str = "error") -> DataFrame:
    """Text of mixed notations to timestamps; absent columns are skipped with a warning."""
    absent = [c for c in columns if c not in df.columns]
    if absent:
        warnings.warn(f"timestamp columns not found, skipped: {absent}", stacklevel=2)
    text = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: _checked(F.col(c), parse_timestamp(F.col(c)), on_unknown, c) for c in text})


def _checked(text: Column, value: Column, on_unknown: str, name: str) -> Column:
    if on_unknown == "null":
        return value
    message = F.concat(F.lit(f"Unexpected value in '{name}': "), text)
    return F.coalesce(value, F.when(text.isNotNull(), F.raise_error(message)))


def temporal_names(columns: tuple[str, ...] | list[str]) -> list[str]:
    return [f"{c.replace('_datetime', '')}_{p}" for c, p in product(columns, PARTS)]


def temporal_features(df: DataFrame, columns: tuple[str, ...] | list[str]) -> DataFrame:
    """Hour, weekday (0 = Monday) and month of each timestamp column, which is dropped."""
    times = (T.TimestampType, T.TimestampNTZType)
    present = [c for c in columns if c in df.columns and isinstance(df.schema[c].dataType, times)]
    parts = {
        name: calendar_part(F.col(c), p)
        for name, (c, p) in zip(temporal_names(present), product(present, PARTS), strict=True)
    }
    return df.withColumns(parts).drop(*present) if parts else df


def ordinal_encode(df: DataFrame, column: str, order: list[str] | tuple[str, ...], on_unknown: str = "error") -> DataFrame:
    """Category to its position in ``order``. A missing value is unknown too."""
    if column not in df.columns:
        return df
    codes = F.create_map(*[x for i, v in enumerate(order) for x in (F.lit(v), F.lit(i))])
    code = F.try_element_at(codes, F.coalesce(F.col(column), F.lit("\u0000")))
    text = F.coalesce(F.col(column), F.lit("NULL"))
    return df.withColumn(column, _checked(text, code, on_unknown, column))


def clean_flow(df: DataFrame, config: CleaningConfig) -> DataFrame:
    """All steps in their fixed order; gaps are filled before text is parsed or encoded."""
    out = (
        df.transform(drop_unnamed)
        .transform(rename_columns, config.rename)
        .transform(drop_columns, config.leakage, config.rename)
        .transform(drop_sparse_rows, config.missing_threshold)
        .transform(impute_missing, config.numeric_strategy, config.categorical_fill)
        .transform(parse_timestamps, config.timestamps, config.on_unknown)
        .transform(temporal_features, config.timestamps)
    )
    for column, order in config.ordinal.items():
        out = out.transform(ordinal_encode, column, order, config.on_unknown)
    return out


def cleaning_report(before: DataFrame, after: DataFrame, config: CleaningConfig) -> DataFrame:
    """One row: table shapes before and after, what was removed and what was added."""
    first = before.agg(F.count(F.lit(1)).alias("initial_rows"))
    last = after.agg(F.count(F.lit(1)).alias("n")).scalar()
    wide, narrow = len(before.columns), len(after.columns)
    return first.select(
        "initial_rows",
        F.lit(wide).alias("initial_cols"),
        last.alias("final_rows"),
        F.lit(narrow).alias("final_cols"),
        (F.col("initial_rows") - last).alias("rows_removed"),
        F.lit(wide - narrow).alias("cols_removed"),
        F.array(*map(F.lit, temporal_names(config.timestamps))).alias("temporal_added"),
        F.array(*map(F.lit, config.ordinal)).alias("ordinal_encoded"),
    )
