"""Rounding and exact sums, where engines and pandas disagree with Spark's defaults."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_scaled(value: Column, digits: int) -> Column:
    """Scale, round half away from zero, scale back: 0.285 gives 0.28, as the product is below 28.5.

    Spark's ``round(x, 2)`` rounds the shortest decimal form and gives 0.29.
    """
    scale = float(10**digits)
    return F.round(value * F.lit(scale), 0) / F.lit(scale)


def round_half_even(value: Column, digits: int) -> Column:
    """Data-frame rounding: scale, round half to even, scale back."""
    scale = float(10**digits)
    return F.rint(value * F.lit(scale)) / F.lit(scale)


def sum_cents(value: Column) -> Column:
    """Order-independent sum of a double that holds at most two decimals."""
    return F.sum(F.round(value * F.lit(100.0), 0).cast("long")) / F.lit(100.0)


def percent(part: Column, whole: Column, digits: int = 1) -> Column:
    """Share in percent; null when the whole is zero or null."""
    return round_half_even(F.try_divide(part, whole) * F.lit(100.0), digits)
