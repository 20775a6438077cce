"""Tables and sentences as a reader sees them.

Each takes finished results, which are small, and stays a DataFrame.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.functions import labels
from lendscope.operators import options
from lendscope.operators.filters import ALL, LoanFilter
from lendscope.operators.measures import INDUSTRY, LENDER, PROGRAM, SECTOR, STATE


def overview_metrics(overview: DataFrame) -> DataFrame:
    """The overview as four labelled texts."""
    shown = {
        "Total Loans": labels.count(F.col("total_loans")),
        "Total Funding": labels.currency(F.col("total_funding")),
        "Average Loan Size": labels.currency(F.col("average_loan_size")),
        "Jobs Supported": labels.count(F.col("total_jobs_supported")),
    }
    lines = [F.struct(F.lit(k).alias("metric"), v.alias("value")) for k, v in shown.items()]
    return overview.select(F.inline(F.array(*lines)))


def industry_table(industries: DataFrame) -> DataFrame:
    """The industry ranking with amounts and counts as texts."""
    return industries.withColumns(
        {
            "total_funding": labels.currency(F.col("total_funding")),
            "total_loans": labels.count(F.col("total_loans")),
        }
    )


def lender_table(lenders: DataFrame) -> DataFrame:
    """The lender ranking with amounts and counts as texts."""
    return industry_table(lenders).withColumn(
        "average_loan_size", labels.currency(F.col("average_loan_size"))
    )


def program_cards(programs: DataFrame) -> DataFrame:
    """One card per program: title, funding, and a line of details."""
    details = F.concat_ws(
        " | ",
        F.concat(labels.count(F.col("total_loans")), F.lit(" loans")),
        F.concat(F.lit("Avg "), labels.currency(F.col("average_loan_size"))),
        F.concat(labels.count(F.col("total_jobs_supported")), F.lit(" jobs")),
    )
    return programs.select(
        F.concat(F.coalesce(PROGRAM, F.lit("None")), F.lit(" Program")).alias("label"),
        labels.currency(F.col("total_funding")).alias("value"),
        details.alias("note"),
    )


def slice_caption(loans: DataFrame, chosen: LoanFilter) -> DataFrame:
    """One row that names the chosen filters; no row when none is chosen."""
    parts: list[Column] = []
    if chosen.state != ALL:
        parts.append(F.lit(f"State: {chosen.state}"))
    if chosen.fiscal_year != ALL:
        parts.append(F.lit(f"Year: {chosen.fiscal_year}"))
    if chosen.naics_code != ALL:
        named = F.coalesce(F.max("label"), F.lit(chosen.naics_code))
        parts.append(F.concat(F.lit("Industry: "), named))
    caption = F.concat(F.lit("Current slice: "), F.concat_ws(" | ", *parts)).alias("caption")
    if not parts:
        return loans.sparkSession.createDataFrame([], "caption string")
    if chosen.naics_code == ALL:
        return loans.sparkSession.range(1).select(caption)
    mine = options.industry_labels(loans.where(F.col(INDUSTRY) == F.lit(chosen.naics_code)))
    return mine.agg(caption)


def scope_note(loans: DataFrame) -> DataFrame:
    """Per program, the fiscal years covered and the latest extract date."""
    scope = loans.groupBy(PROGRAM).agg(
        F.min("approval_fiscal_year").alias("min_year"),
        F.max("approval_fiscal_year").alias("max_year"),
        F.max("as_of_date").alias("latest"),
    )
    years = F.concat_ws("-", F.col("min_year"), F.col("max_year"))
    note = F.concat(
        F.coalesce(PROGRAM, F.lit("None")),
        F.lit(" loans from fiscal years "),
        years,
        F.lit(". Latest extract date: "),
        labels.long_date(F.col("latest")),
        F.lit("."),
    )
    return scope.select(PROGRAM, note.alias("note"))


# Cards, and what they say when there is nothing to show.
_CARDS = (
    (1, "Top State", "No state-level funding matched the current filters."),
    (2, "Top Industry", "No industry results matched the current filters."),
    (3, "Highest Risk Sector", "No charge-off benchmark met the minimum funding threshold."),
    (4, "Top Lender", "No lender-level funding results matched the current filters."),
)
_NO_DATA = "No data"


def _funding_across_loans() -> Column:
    funding, loans = F.col("total_funding"), F.col("total_loans")
    return F.concat(
        labels.currency(funding), F.lit(" across "), labels.count(loans), F.lit(" loans.")
    )


def key_findings(
    states: DataFrame, industries: DataFrame, sectors: DataFrame, lenders: DataFrame
) -> DataFrame:
    """H6: four cards made of the leaders of four rankings.

    A ranking without rows gives its card a line that says so.
    """
    funding = labels.currency(F.col("total_funding"))
    rate = labels.percent(F.col("charge_off_rate"))
    leaders = [
        (1, states, STATE, F.concat(funding, F.lit(" in approved funding."))),
        (2, industries, "naics_description", _funding_across_loans()),
        (3, sectors, SECTOR, F.concat(rate, F.lit(" charge-off rate on "), funding, F.lit("."))),
        (4, lenders, LENDER, _funding_across_loans()),
    ]
    found = [
        ranking.limit(1).select(
            F.lit(position).alias("position"), F.col(name).alias("value"), note.alias("note")
        )
        for position, ranking, name, note in leaders
    ]
    cards = states.sparkSession.createDataFrame(
        list(_CARDS), "position int, label string, nothing string"
    )
    return (
        cards.join(reduce(DataFrame.unionByName, found), "position", "left")
        .select(
            "position",
            "label",
            F.coalesce("value", F.lit(_NO_DATA)).alias("value"),
            F.coalesce("note", "nothing").alias("note"),
        )
        .orderBy("position")
    )
