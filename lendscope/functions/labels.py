"""Texts shown to a reader."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lendscope.functions.ratios import or_zero


def currency(value: Column) -> Column:
    """``$1,234``; ``$0`` when unknown.  Halves round to even."""
    return F.concat(F.lit("$"), F.format_number(or_zero(value), 0))


def count(value: Column) -> Column:
    """``1,234``; ``0`` when unknown.  Fractions are cut off."""
    return F.format_number(or_zero(value.cast("long")), 0)


def percent(value: Column) -> Column:
    """``4.1%`` for 0.041; ``0.0%`` when unknown.  Halves round to even."""
    scaled = F.coalesce(value.cast("double"), F.lit(0.0)) * 100
    return F.format_string("%.1f%%", F.bround(scaled, 1))


def option(code: Column, description: Column) -> Column:
    """``code - description``."""
    return F.concat_ws(" - ", code, description)


def long_date(value: Column) -> Column:
    """``December 31, 2025``; ``Unknown`` when there is no date."""
    return F.coalesce(F.date_format(value, "MMMM dd, yyyy"), F.lit("Unknown"))
