"""Choices offered by the filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.functions import labels
from lendscope.model import UNKNOWN
from lendscope.operators.filters import ALL, known
from lendscope.operators.ranking import options_order


def states(loans: DataFrame) -> DataFrame:
    """the known states, in order."""
    found = known(loans, "borrower_state").select("borrower_state").distinct()
    return options_order(found, "borrower_state")


def fiscal_years(loans: DataFrame) -> DataFrame:
    """the known fiscal years, in order."""
    found = known(loans, "approval_fiscal_year").select("approval_fiscal_year").distinct()
    return options_order(found, "approval_fiscal_year")


def industries(loans: DataFrame) -> DataFrame:
    """the known industry codes with each description they came with."""
    description = F.coalesce("naics_description", F.lit(UNKNOWN)).alias("naics_description")
    found = known(loans, "naics_code").select("naics_code", description).distinct()
    return options_order(found, "naics_code", "naics_description")


def industry_labels(loans: DataFrame) -> DataFrame:
    """Each industry with the label shown for it."""
    label = labels.option(F.col("naics_code"), F.col("naics_description"))
    return industries(loans).select("naics_code", label.alias("label"))


def with_all(options: DataFrame, value: Column) -> DataFrame:
    """the options as text, with ``All`` in front of them."""
    everything = options.sparkSession.range(1).select(
        F.lit(0).alias("position"), F.lit(ALL).alias("option")
    )
    listed = options.select(F.lit(1).alias("position"), value.cast("string").alias("option"))
    return everything.unionByName(listed).orderBy("position", "option")
