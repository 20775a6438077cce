"""Ratios of sums.

Money is summed exactly as decimals.  A ratio divides the finished sums as
doubles, so it never depends on the order in which rows were added.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(value: Column) -> Column:
    """The value, or 0 when unknown."""
    return F.coalesce(value, F.lit(0))


def safe_ratio(numerator: Column, denominator: Column, on_zero: float | None = None) -> Column:
    """``numerator / denominator``; ``on_zero`` when the denominator is 0.

    A null denominator gives null, whatever ``on_zero`` is.
    """
    ratio = numerator.cast("double") / denominator.cast("double")
    return F.when(denominator == 0, F.lit(on_zero).cast("double")).otherwise(ratio)


def per_million(numerator: Column, denominator: Column, on_zero: float | None = 0) -> Column:
    """The ratio per one million of the denominator."""
    return safe_ratio(numerator, denominator, on_zero) * F.lit(1_000_000.0)
