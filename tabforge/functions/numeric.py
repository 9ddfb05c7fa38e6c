"""Numeric column expressions whose edge cases differ between engines."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(c: Column | str, digits: int = 0) -> Column:
    """Round half to even by scale, ``rint``, unscale.

    ``bround`` works on the decimal text of the double and gives a different
    last digit on about 4 % of half-way cents values (1.015 -> 1.02, not 1.01).
    """
    x = col(c).cast("double")
    if digits == 0:
        return F.rint(x)
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def not_nan(c: Column | str) -> Column:
    """NaN counts as missing, as it does in a dataframe library."""
    x = col(c).cast("double")
    return F.when(~F.isnan(x), x)


def percent(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def pct_over(value: Column, base: Column, digits: int = 1) -> Column:
    """Percentage by which ``value`` exceeds ``base``."""
    return half_even(F.try_divide(value - base, base) * F.lit(100.0), digits)


def sample_skewness(x: Column) -> Column:
    """Bias-corrected skewness; NULL under three values, 0 for a constant."""
    n = F.count(x).cast("double")
    factor = F.sqrt(n * (n - 1)) / F.nullif(n - 2, F.lit(0.0))
    return F.when(
        F.count(x) >= 3,
        F.when(F.stddev_pop(x) > 0, F.skewness(x) * factor).otherwise(F.lit(0.0)),
    )
