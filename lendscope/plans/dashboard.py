"""The dashboard bundle."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.operators import display, kept_totals, measures, options
from lendscope.operators.filters import NO_FILTER, LoanFilter
from lendscope.operators.kept_totals import KeptFacets
from lendscope.operators.measures import FACT_COLUMNS, Facets


@dataclass(frozen=True)
class Dashboard:
    """All frames of one dashboard page.  ``release`` frees what they share."""

    scope: DataFrame
    states: DataFrame
    fiscal_years: DataFrame
    industries: DataFrame
    caption: DataFrame
    panels: dict[str, DataFrame]
    findings: DataFrame
    facets: Facets

    def release(self) -> None:
        """Give up the shared totals, for example when the table was reloaded."""
        self.facets.release()


def _panels(facets: Facets) -> dict[str, DataFrame]:
    return {
        "overview": measures.overview(facets),
        "state_funding": measures.state_funding(facets),
        "industry_analysis": measures.industry_analysis(facets),
        "loan_status": measures.loan_status(facets),
        "charge_off_rate_by_sector": measures.charge_off_rate_by_sector(facets),
        "average_loan_by_state": measures.average_loan_by_state(facets),
        "guarantee_share_by_industry": measures.guarantee_share_by_industry(facets),
        "top_lenders": measures.top_lenders(facets),
        "jobs_per_million_by_state": measures.jobs_per_million_by_state(facets),
        "program_comparison": measures.program_comparison(facets),
    }


def _findings(panels: dict[str, DataFrame]) -> DataFrame:
    return display.key_findings(
        panels["state_funding"],
        panels["industry_analysis"],
        panels["charge_off_rate_by_sector"],
        panels["top_lenders"],
    )


def dashboard(loans: DataFrame, chosen: LoanFilter = NO_FILTER) -> Dashboard:
    """H5: scope, filter choices, and ten aggregates of one slice.

    The ten aggregates share one pass over the slice: its totals per key are
    kept (A19), and each panel reads those few rows.  Keeping the slice itself
    would need memory in step with the data.
    """
    fact = loans.select(*[c for c in FACT_COLUMNS if c in loans.columns])
    facets = Facets(chosen.apply(fact))
    panels = _panels(facets)
    return Dashboard(
        scope=measures.dataset_scope(fact),
        states=options.states(fact),
        fiscal_years=options.fiscal_years(fact),
        industries=options.industries(fact),
        caption=display.slice_caption(fact, chosen),
        panels=panels,
        findings=_findings(panels),
        facets=facets,
    )


def kept_dashboard(totals: DataFrame, chosen: LoanFilter = NO_FILTER) -> Dashboard:
    """H5 from stored totals (A19): no part of the page reads the loans."""
    facets, everything = KeptFacets(totals, chosen), KeptFacets(totals, NO_FILTER)
    panels = _panels(facets)
    return Dashboard(
        scope=kept_totals.dataset_scope(everything),
        states=options.states(everything.rows(measures.STATE)),
        fiscal_years=options.fiscal_years(everything.rows(kept_totals.YEAR)),
        industries=options.industries(everything.rows(measures.INDUSTRY)),
        caption=display.slice_caption(everything.rows(measures.INDUSTRY), chosen),
        panels=panels,
        findings=_findings(panels),
        facets=facets,
    )


# Panel: (text that names a row, measure of the panel).
_PANEL_LINES = {
    "overview": (None, "total_funding"),
    "state_funding": ("borrower_state", "total_funding"),
    "industry_analysis": ("naics_code", "total_funding"),
    "loan_status": ("loan_status", "total_loans"),
    "charge_off_rate_by_sector": ("sector", "charge_off_rate"),
    "average_loan_by_state": ("borrower_state", "average_loan_size"),
    "guarantee_share_by_industry": ("naics_code", "guarantee_share"),
    "top_lenders": ("lender_name", "total_funding"),
    "jobs_per_million_by_state": ("borrower_state", "jobs_per_million"),
    "program_comparison": ("program", "total_funding"),
}


def panel_lines(page: Dashboard) -> DataFrame:
    """All panels under one another: panel, row name, and the panel's measure."""
    lines = None
    for panel, (name, measure) in _PANEL_LINES.items():
        line = page.panels[panel].select(
            F.lit(panel).alias("panel"),
            (F.col(name) if name else F.lit("All")).alias("item"),
            F.col(measure).cast("double").alias("value"),
        )
        lines = line if lines is None else lines.unionByName(line)
    return lines
