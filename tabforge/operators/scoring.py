"""Validation and scoring of rows; the same functions serve tables and streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import Model
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabforge.functions.numeric import half_even

# The ranges a scoring request must respect.
REQUEST_RULES: dict[str, str] = {
    "stopovers": "stopovers BETWEEN 0 AND 2",
    "duration": "duration > 0",
    "days_left": "days_left >= 1",
    "departure_hour": "departure_hour BETWEEN 0 AND 23",
    "departure_day_of_week": "departure_day_of_week BETWEEN 0 AND 6",
    "departure_month": "departure_month BETWEEN 1 AND 12",
    "arrival_hour": "arrival_hour BETWEEN 0 AND 23",
    "arrival_day_of_week": "arrival_day_of_week BETWEEN 0 AND 6",
    "arrival_month": "arrival_month BETWEEN 1 AND 12",
}


def validate(df: DataFrame, rules: dict[str, str], required: list[str] | tuple[str, ...] = ()) -> DataFrame:
    """Adds ``reasons``: the rules a row breaks (a missing value breaks its rule)."""
    checks: dict[str, Column] = {c: F.col(c).isNotNull() for c in required}
    checks |= {name: F.coalesce(F.expr(rule), F.lit(False)) for name, rule in rules.items()}
    broken = [F.when(~ok, F.lit(name)) for name, ok in checks.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*broken)))


def accepted(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("reasons") == 0).drop("reasons")


def rejected(validated: DataFrame) -> DataFrame:
    return validated.where(F.size("reasons") > 0)


def score(df: DataFrame, model: Model, prepare: Callable[[DataFrame], DataFrame] | None = None, log_target: bool = True) -> DataFrame:
    """Adds ``predicted``, on the original scale and rounded to 2 digits.

    ``prepare`` is the ``transform`` of the fitted feature model, so scoring has
    no second implementation of the features.
    """
    scored = model.transform(prepare(df) if prepare else df)
    value = F.expm1("prediction") if log_target else F.col("prediction")
    return scored.withColumn("predicted", half_even(value, 2))
