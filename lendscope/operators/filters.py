"""Filters of a slice of loans."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ALL = "All"


@dataclass(frozen=True)
class LoanFilter:
    """A chosen state, fiscal year and industry; ``All`` means no condition.

    The conditions are plain column comparisons with literals (C8), so they
    reach the Parquet scan as partition and row-group filters.
    """

    state: str = ALL
    fiscal_year: int | str = ALL
    naics_code: str = ALL

    def predicates(self) -> list[Column]:
        """The chosen conditions, each on one column."""
        chosen = []
        if self.state != ALL:
            chosen.append(F.col("borrower_state") == F.lit(self.state))
        if self.fiscal_year != ALL:
            chosen.append(F.col("approval_fiscal_year") == F.lit(int(self.fiscal_year)))
        if self.naics_code != ALL:
            chosen.append(F.col("naics_code") == F.lit(self.naics_code))
        return chosen

    def apply(self, loans: DataFrame) -> DataFrame:
        """The rows that meet all chosen conditions."""
        chosen = self.predicates()
        return loans.where(reduce(and_, chosen)) if chosen else loans


NO_FILTER = LoanFilter()


def known(df: DataFrame, key: str) -> DataFrame:
    """Rows whose group key is known."""
    return df.where(F.col(key).isNotNull())


def at_least(totals: DataFrame, measure: str, minimum: float) -> DataFrame:
    """Groups whose measure reaches the minimum."""
    return totals.where(F.col(measure) >= F.lit(minimum))


def is_empty_slice(overview: DataFrame) -> DataFrame:
    """One row that says whether the overview counted no loan."""
    return overview.select((F.col("total_loans") == 0).alias("no_loans"))
