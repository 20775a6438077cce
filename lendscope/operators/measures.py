"""Loan aggregates.

Every question is a rank or a projection over one kind of table: the totals of
the loans per key.  Totals come either straight from the loans (``totals``) or
from one shared pass over them (``Facets``); the questions take both.

Totals are hash aggregates with a partial step in each task.  The industry
totals also need the largest description of a code.  A maximum of texts cannot
be kept in a hash aggregate and would sort every loan, so loans are first added
up per (code, description), and the maximum is taken over those few rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope import model
from lendscope.functions.ratios import or_zero, per_million, safe_ratio
from lendscope.functions.sectors import sector_of
from lendscope.operators import filters, ranking
from lendscope.operators.filters import NO_FILTER, LoanFilter
from lendscope.session import scratch_path

STATE, INDUSTRY, STATUS, SECTOR, LENDER, PROGRAM = (
    "borrower_state", "naics_code", "loan_status", "sector", "lender_name", "program",
)

# Keys whose unknown value is not a group of its own.
_NEEDS_KEY = {STATE, INDUSTRY, STATUS, LENDER}

# What is summed per group: column, name of its total.  Sums are exact.
_SUMS = {
    "loan_amount": "total_funding",
    "jobs_supported": "total_jobs_supported",
    "charge_off_amount": "total_charge_off_amount",
    "sba_guaranteed_approval": "guaranteed_funding",
}

FACT_COLUMNS = [
    STATE, "approval_fiscal_year", INDUSTRY, "naics_description", STATUS, LENDER, PROGRAM,
    "loan_amount", "sba_guaranteed_approval", "charge_off_amount", "jobs_supported", "as_of_date",
]


def loan_measures(fact: DataFrame) -> list[Column]:
    """Count and sums of the amounts that ``fact`` has."""
    sums = [F.sum(c).alias(name) for c, name in _SUMS.items() if c in fact.columns]
    if "loan_amount" in fact.columns:
        sums.append(F.count("loan_amount").alias("known_amounts"))
    return [F.count(F.lit(1)).alias("total_loans"), *sums]


def added_up(rows: DataFrame) -> list[Column]:
    """Totals of totals."""
    names = [c for c in ("known_amounts", *_SUMS.values()) if c in rows.columns]
    counted = F.coalesce(F.sum("total_loans"), F.lit(0)).alias("total_loans")
    return [counted, *[F.sum(name).alias(name) for name in names]]


def _finished(rows: DataFrame, *keys: str) -> DataFrame:
    """Totals with unknown amounts as 0.  A sum over no loan at all stays null."""
    some = F.col("total_loans") > 0
    total = {
        name: F.when(some, or_zero(F.col(name))).alias(name)
        for name in _SUMS.values()
        if name in rows.columns
    }
    if "total_funding" in total:
        added, known = F.col("total_funding").cast("double"), F.col("known_amounts")
        total["average"] = F.try_divide(added, known).alias("average_loan_size")
    return rows.select(*keys, "total_loans", *total.values())


def _one_row_per_industry(rows: DataFrame) -> DataFrame:
    described = F.coalesce(F.max("naics_description"), F.lit(model.UNKNOWN))
    return rows.groupBy(INDUSTRY).agg(described.alias("naics_description"), *added_up(rows))


def _per_sector(rows: DataFrame) -> DataFrame:
    sector = sector_of(F.col(INDUSTRY)).alias(SECTOR)
    return rows.groupBy(sector).agg(*added_up(rows))


def totals(loans: DataFrame | Facets, key: str | None = None) -> DataFrame:
    """All measures per value of ``key``, or over all loans.

    A question selects the measures it needs; Spark drops the others, and the
    columns under them, from the aggregate and from the scan.
    """
    if isinstance(loans, Facets):
        return loans.totals(key)
    if key is None:
        return _finished(loans.agg(*loan_measures(loans)))
    if key in _NEEDS_KEY:
        loans = filters.known(loans, key)
    if key == SECTOR:
        # The sector depends on two digits; it is looked up once per pair of them.
        digits = loans.withColumn(INDUSTRY, F.left(INDUSTRY, F.lit(2)))
        return _finished(_per_sector(digits.groupBy(INDUSTRY).agg(*loan_measures(loans))), SECTOR)
    if key == INDUSTRY:
        fine = loans.groupBy(INDUSTRY, "naics_description").agg(*loan_measures(loans))
        return _finished(_one_row_per_industry(fine), INDUSTRY, "naics_description")
    return _finished(loans.groupBy(key).agg(*loan_measures(loans)), key)


class Facets:
    """Totals for every key from one pass over the loans.

    The pass is a single GROUPING SETS aggregate.  Its result has one row per
    state, industry and description, status, lender and program; sectors are added
    up from industries, and the whole from programs.  It is stored in the shared folder
    and kept with ``persist``: Spark finds a kept aggregate only once in a plan that holds
    it several times, as one over several panels does, and a kept file every time.
    """

    _SETS = {
        STATE: (STATE,),
        INDUSTRY: (INDUSTRY, "naics_description"),
        STATUS: (STATUS,),
        LENDER: (LENDER,),
        PROGRAM: (PROGRAM,),
    }
    _KEYS = (STATE, INDUSTRY, "naics_description", STATUS, LENDER, PROGRAM)

    def __init__(self, loans: DataFrame):
        totals = loans.groupingSets(list(self._SETS.values()), *self._KEYS).agg(
            F.grouping_id().alias("grouping"), *loan_measures(loans)
        )
        stored = scratch_path(loans.sparkSession, "facets")
        totals.write.parquet(stored)
        self.table = loans.sparkSession.read.schema(totals.schema).parquet(stored).persist()

    def rows(self, key: str) -> DataFrame:
        """The rows of one grouping set."""
        kept = self._SETS[key]
        # A bit of the grouping id is 1 where the key is not part of the set.
        grouping = int("".join("0" if k in kept else "1" for k in self._KEYS), 2)
        return self.table.where(F.col("grouping") == grouping)

    def totals(self, key: str | None) -> DataFrame:
        """The totals of one key, as ``totals`` gives them."""
        if key is None:
            rows = self.rows(PROGRAM)
            return _finished(rows.agg(*added_up(rows)))
        if key == SECTOR:
            return _finished(_per_sector(self.rows(INDUSTRY)), SECTOR)
        rows = self.rows(key)
        if key in _NEEDS_KEY:
            rows = filters.known(rows, key)
        if key == INDUSTRY:
            return _finished(_one_row_per_industry(rows), INDUSTRY, "naics_description")
        return _finished(rows, key)

    def release(self) -> None:
        """Give the memory back; answers are then read from the stored totals."""
        self.table.unpersist()


# Views over all loans.


def state_view(loans: DataFrame) -> DataFrame:
    """D3: the four measures per state."""
    return totals(loans, STATE).select(
        STATE, "total_loans", "total_funding", "average_loan_size", "total_jobs_supported"
    )


def industry_view(loans: DataFrame) -> DataFrame:
    """The four measures per industry code."""
    return totals(loans, INDUSTRY).select(
        INDUSTRY, "naics_description", "total_loans", "total_funding",
        "average_loan_size", "total_jobs_supported",
    )


def status_view(loans: DataFrame) -> DataFrame:
    """Count, funding and charged-off amount per status."""
    return totals(loans, STATUS).select(
        STATUS, "total_loans", "total_funding", "total_charge_off_amount"
    )


def jobs_per_dollar_view(loans: DataFrame) -> DataFrame:
    """Jobs per dollar over all loans; null without funding."""
    whole = totals(loans)
    ratio = safe_ratio(F.col("total_jobs_supported"), F.col("total_funding"), on_zero=None)
    return whole.select("total_jobs_supported", "total_funding", ratio.alias("jobs_per_dollar"))


def dataset_scope(loans: DataFrame) -> DataFrame:
    """How many loans, which fiscal years, and how recent."""
    return loans.agg(
        F.count(F.lit(1)).alias("total_loans"),
        F.min("approval_fiscal_year").alias("min_year"),
        F.max("approval_fiscal_year").alias("max_year"),
        F.max("as_of_date").alias("latest_as_of_date"),
    )


# Questions about a slice.  ``loans`` may be Facets, which hold a slice already.


def _slice(loans: DataFrame | Facets, chosen: LoanFilter) -> DataFrame | Facets:
    if isinstance(loans, Facets):
        if chosen != NO_FILTER:
            raise ValueError("filter the loans before building Facets")
        return loans
    return chosen.apply(loans)


def overview(loans: DataFrame | Facets, chosen: LoanFilter = NO_FILTER) -> DataFrame:
    """The four measures of the slice; only the count is known for no loans."""
    return totals(_slice(loans, chosen)).select(
        "total_loans", "total_funding", "average_loan_size", "total_jobs_supported"
    )


def state_funding(loans: DataFrame | Facets, chosen: LoanFilter = NO_FILTER) -> DataFrame:
    """Funding per state, largest first."""
    found = totals(_slice(loans, chosen), STATE).select(STATE, "total_funding")
    return ranking.ranked(found, "total_funding", tie=STATE)


def industry_analysis(
    loans: DataFrame | Facets, chosen: LoanFilter = NO_FILTER, k: int = model.TOP_INDUSTRIES
) -> DataFrame:
    """The industries with most funding."""
    found = totals(_slice(loans, chosen), INDUSTRY).select(
        INDUSTRY, "naics_description", "total_loans", "total_funding"
    )
    return ranking.top(found, k, "total_funding", tie=INDUSTRY)


def loan_status(loans: DataFrame | Facets, chosen: LoanFilter = NO_FILTER) -> DataFrame:
    """Loans per status, most frequent first; no status counts as Unknown."""
    source = _slice(loans, chosen)
    if isinstance(source, Facets):
        counts = source.rows(STATUS).select(STATUS, "total_loans")
    else:
        counts = source.groupBy(STATUS).agg(F.count(F.lit(1)).alias("total_loans"))
    label = F.coalesce(STATUS, F.lit(model.UNKNOWN)).alias(STATUS)
    found = counts.groupBy(label).agg(F.sum("total_loans").alias("total_loans"))
    return ranking.ranked(found, "total_loans", tie=STATUS)


def charge_off_rate_by_sector(
    loans: DataFrame | Facets,
    chosen: LoanFilter = NO_FILTER,
    minimum_funding: float = model.MIN_SECTOR_FUNDING,
    k: int = model.TOP_RANKED,
) -> DataFrame:
    """The funded sectors with the largest share charged off."""
    rate = safe_ratio(F.col("total_charge_off_amount"), F.col("total_funding"), on_zero=0)
    found = filters.at_least(
        totals(_slice(loans, chosen), SECTOR), "total_funding", minimum_funding
    ).select(
        SECTOR, "total_loans", "total_funding", "total_charge_off_amount",
        rate.alias("charge_off_rate"),
    )
    return ranking.top(found, k, "charge_off_rate", "total_charge_off_amount", tie=SECTOR)


def average_loan_by_state(
    loans: DataFrame | Facets,
    chosen: LoanFilter = NO_FILTER,
    minimum_loans: int = model.MIN_STATE_LOANS,
    k: int = model.TOP_RANKED,
) -> DataFrame:
    """The states with the largest average loan."""
    found = filters.at_least(
        totals(_slice(loans, chosen), STATE), "total_loans", minimum_loans
    ).select(STATE, "total_loans", "average_loan_size", "total_funding")
    return ranking.top(found, k, "average_loan_size", tie=STATE)


def guarantee_share_by_industry(
    loans: DataFrame | Facets,
    chosen: LoanFilter = NO_FILTER,
    minimum_loans: int = model.MIN_INDUSTRY_LOANS,
    k: int = model.TOP_RANKED,
) -> DataFrame:
    """The industries with the largest guaranteed share."""
    share = safe_ratio(F.col("guaranteed_funding"), F.col("total_funding"), on_zero=0)
    found = filters.at_least(
        totals(_slice(loans, chosen), INDUSTRY), "total_loans", minimum_loans
    ).select(
        INDUSTRY, "naics_description", "total_loans", "total_funding", "guaranteed_funding",
        share.alias("guarantee_share"),
    )
    return ranking.top(found, k, "guarantee_share", "total_funding", tie=INDUSTRY)


def top_lenders(
    loans: DataFrame | Facets,
    chosen: LoanFilter = NO_FILTER,
    minimum_loans: int = model.MIN_LENDER_LOANS,
    k: int = model.TOP_RANKED,
) -> DataFrame:
    """The lenders with most funding."""
    found = filters.at_least(
        totals(_slice(loans, chosen), LENDER), "total_loans", minimum_loans
    ).select(LENDER, "total_loans", "total_funding", "average_loan_size")
    return ranking.top(found, k, "total_funding", tie=LENDER)


def jobs_per_million_by_state(
    loans: DataFrame | Facets,
    chosen: LoanFilter = NO_FILTER,
    minimum_funding: float = model.MIN_STATE_FUNDING,
    k: int = model.TOP_RANKED,
) -> DataFrame:
    """The funded states with most jobs per million dollars."""
    intensity = per_million(F.col("total_jobs_supported"), F.col("total_funding"))
    found = filters.at_least(
        totals(_slice(loans, chosen), STATE), "total_funding", minimum_funding
    ).select(
        STATE, "total_loans", "total_jobs_supported", "total_funding",
        intensity.alias("jobs_per_million"),
    )
    return ranking.top(found, k, "jobs_per_million", tie=STATE)


def program_comparison(loans: DataFrame | Facets, chosen: LoanFilter = NO_FILTER) -> DataFrame:
    """The four measures per program, unknown program included.

    The programs cover different years, so this compares what was collected.
    """
    found = totals(_slice(loans, chosen), PROGRAM).select(
        PROGRAM, "total_loans", "total_funding", "average_loan_size", "total_jobs_supported"
    )
    return ranking.ranked(found, "total_funding", tie=PROGRAM)
