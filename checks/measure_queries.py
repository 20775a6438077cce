"""Aggregates, filters, rankings and options over the derived loans (C, D, E, F)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import loans
from checks.results import plain
from lendscope.model import SECTORS
from lendscope.operators import cleaning, measures, options, profiling, ranking
from lendscope.operators.filters import LoanFilter, is_empty_slice
from lendscope.sources.csv_files import union_by_name

Query = tuple[Callable[[SparkSession, str], DataFrame], str]

N = "COUNT(*) AS total_loans"
FUNDING = "CAST(SUM(COALESCE(loan_amount, 0)) AS DOUBLE)"
AVERAGE = "CAST(SUM(loan_amount) AS DOUBLE) / COUNT(loan_amount) AS average_loan_size"
JOBS = "CAST(SUM(COALESCE(jobs_supported, 0)) AS BIGINT)"
CHARGED = "CAST(SUM(COALESCE(charge_off_amount, 0)) AS DOUBLE)"
GUARANTEED = "CAST(SUM(COALESCE(sba_guaranteed_approval, 0)) AS DOUBLE)"
FOUR = f"{N}, {FUNDING} AS total_funding, {AVERAGE}, {JOBS} AS total_jobs_supported"
DESCRIPTION = "COALESCE(MAX(naics_description), 'Unknown') AS naics_description"
SECTOR = (
    "CASE WHEN naics_code IS NULL THEN 'Unknown' "
    + " ".join(f"WHEN left(naics_code, 2) = '{k}' THEN '{v}'" for k, v in SECTORS.items())
    + " ELSE 'Other / Unclassified' END"
)


def over_loans(query: str) -> str:
    """SQL that may use ``loans``."""
    return f"WITH loans AS ({loans.SQL}) {query}"


def _ratio(top: str, bottom: str, on_zero: str) -> str:
    return f"CASE WHEN {bottom} = 0 THEN {on_zero} ELSE {top} / {bottom} END"


@dataclass(frozen=True)
class Question:
    """One aggregate: the function, the columns it needs, and its SQL parts."""

    ask: Callable[..., DataFrame]
    columns: tuple[str, ...]
    select: str
    key: str | None = None
    needs_key: bool = True
    having: str | None = None
    order: str | None = None

    def sql(self, where: str | None = None, having: str | None = None) -> str:
        """The question as SQL over ``loans``."""
        conditions = [c for c in (where, f"{self.key} IS NOT NULL" if self._guard else None) if c]
        having = having or self.having
        return " ".join(
            part
            for part in (
                f"SELECT {self.select} FROM loans",
                f"WHERE {' AND '.join(conditions)}" if conditions else "",
                f"GROUP BY {self.key}" if self.key else "",
                f"HAVING {having}" if having else "",
                f"ORDER BY {self.order}" if self.order else "",
            )
            if part
        )

    @property
    def _guard(self) -> bool:
        return bool(self.key) and self.needs_key


_FOUR_COLUMNS = ("loan_amount", "jobs_supported")
QUESTIONS: dict[str, Question] = {
    "d1_overview": Question(measures.overview, _FOUR_COLUMNS, FOUR),
    "d7_state_funding": Question(
        measures.state_funding,
        ("borrower_state", "loan_amount"),
        f"borrower_state, {FUNDING} AS total_funding",
        key="borrower_state",
    ),
    "d8_industry_analysis": Question(
        measures.industry_analysis,
        ("naics_code", "naics_description", "loan_amount"),
        f"naics_code, {DESCRIPTION}, {N}, {FUNDING} AS total_funding",
        key="naics_code",
        order="total_funding DESC NULLS FIRST, naics_code LIMIT 20",
    ),
    "d9_loan_status": Question(
        measures.loan_status,
        ("loan_status",),
        f"COALESCE(loan_status, 'Unknown') AS loan_status, {N}",
        key="COALESCE(loan_status, 'Unknown')",
        needs_key=False,
    ),
    "d10_charge_off_by_sector": Question(
        measures.charge_off_rate_by_sector,
        ("naics_code", "loan_amount", "charge_off_amount"),
        f"{SECTOR} AS sector, {N}, {FUNDING} AS total_funding, "
        f"{CHARGED} AS total_charge_off_amount, {_ratio(CHARGED, FUNDING, '0')} AS charge_off_rate",
        key=SECTOR,
        needs_key=False,
        having="SUM(COALESCE(loan_amount, 0)) >= 50000000",
        order="charge_off_rate DESC NULLS FIRST, total_charge_off_amount DESC NULLS FIRST, "
        "sector LIMIT 10",
    ),
    "d11_average_by_state": Question(
        measures.average_loan_by_state,
        ("borrower_state", "loan_amount"),
        f"borrower_state, {N}, {AVERAGE}, {FUNDING} AS total_funding",
        key="borrower_state",
        having="COUNT(*) >= 250",
        order="average_loan_size DESC NULLS FIRST, borrower_state LIMIT 10",
    ),
    "d12_guarantee_share": Question(
        measures.guarantee_share_by_industry,
        ("naics_code", "naics_description", "loan_amount", "sba_guaranteed_approval"),
        f"naics_code, {DESCRIPTION}, {N}, {FUNDING} AS total_funding, "
        f"{GUARANTEED} AS guaranteed_funding, {_ratio(GUARANTEED, FUNDING, '0')} AS guarantee_share",
        key="naics_code",
        having="COUNT(*) >= 100",
        order="guarantee_share DESC NULLS FIRST, total_funding DESC NULLS FIRST, "
        "naics_code LIMIT 10",
    ),
    "d13_top_lenders": Question(
        measures.top_lenders,
        ("lender_name", "loan_amount"),
        f"lender_name, {N}, {FUNDING} AS total_funding, {AVERAGE}",
        key="lender_name",
        having="COUNT(*) >= 100",
        order="total_funding DESC NULLS FIRST, lender_name LIMIT 10",
    ),
    "d14_jobs_per_million": Question(
        measures.jobs_per_million_by_state,
        ("borrower_state", "loan_amount", "jobs_supported"),
        f"borrower_state, {N}, {JOBS} AS total_jobs_supported, {FUNDING} AS total_funding, "
        f"{_ratio(f'CAST({JOBS} AS DOUBLE)', FUNDING, '0')} * 1000000.0 AS jobs_per_million",
        key="borrower_state",
        having="SUM(COALESCE(loan_amount, 0)) >= 25000000",
        order="jobs_per_million DESC NULLS FIRST, borrower_state LIMIT 10",
    ),
    "d15_program_comparison": Question(
        measures.program_comparison,
        ("program", *_FOUR_COLUMNS),
        f"program, {FOUR}",
        key="program",
        needs_key=False,
    ),
}

VIEW_QUESTIONS: dict[str, Question] = {
    "d2_dataset_scope": Question(
        measures.dataset_scope,
        ("approval_fiscal_year", "as_of_date"),
        f"{N}, MIN(approval_fiscal_year) AS min_year, MAX(approval_fiscal_year) AS max_year, "
        "CAST(MAX(as_of_date) AS VARCHAR) AS latest_as_of_date",
    ),
    "d3_state_view": Question(
        measures.state_view,
        ("borrower_state", *_FOUR_COLUMNS),
        f"borrower_state, {FOUR}",
        key="borrower_state",
    ),
    "d4_industry_view": Question(
        measures.industry_view,
        ("naics_code", "naics_description", *_FOUR_COLUMNS),
        f"naics_code, {DESCRIPTION}, {FOUR}",
        key="naics_code",
    ),
    "d5_status_view": Question(
        measures.status_view,
        ("loan_status", "loan_amount", "charge_off_amount"),
        f"loan_status, {N}, {FUNDING} AS total_funding, {CHARGED} AS total_charge_off_amount",
        key="loan_status",
    ),
    "d6_jobs_per_dollar": Question(
        measures.jobs_per_dollar_view,
        _FOUR_COLUMNS,
        f"{JOBS} AS total_jobs_supported, {FUNDING} AS total_funding, "
        f"{_ratio(f'CAST({JOBS} AS DOUBLE)', FUNDING, 'NULL')} AS jobs_per_dollar",
    ),
}

# The questions again over a slice, with thresholds that leave something of it.
_YEAR = LoanFilter(fiscal_year=1998)
_STATE_YEAR = LoanFilter("NATION_3", 1998)
_INDUSTRY = LoanFilter(naics_code="470018")
_SLICES: dict[str, tuple[LoanFilter, str]] = {
    "in_year": (_YEAR, "approval_fiscal_year = 1998"),
    "in_state_year": (_STATE_YEAR, "borrower_state = 'NATION_3' AND approval_fiscal_year = 1998"),
    "in_industry": (_INDUSTRY, "naics_code = '470018'"),
}
_LOWERED: dict[str, tuple[dict[str, int], str]] = {
    "d10_charge_off_by_sector": (
        {"minimum_funding": 200_000},
        "SUM(COALESCE(loan_amount, 0)) >= 200000",
    ),
    "d11_average_by_state": ({"minimum_loans": 3}, "COUNT(*) >= 3"),
    "d12_guarantee_share": ({"minimum_loans": 3}, "COUNT(*) >= 3"),
    "d13_top_lenders": ({"minimum_loans": 2}, "COUNT(*) >= 2"),
    "d14_jobs_per_million": (
        {"minimum_funding": 100_000},
        "SUM(COALESCE(loan_amount, 0)) >= 100000",
    ),
}
_FILTER_COLUMNS = ("borrower_state", "approval_fiscal_year", "naics_code")


def _columns(*names: str) -> list[str]:
    return list(dict.fromkeys(names))


def _whole(question: Question) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(question.ask(loans.derive(spark, sf_dir, *question.columns)))

    return run, over_loans(question.sql())


def _sliced(name: str, question: Question, chosen: LoanFilter, where: str) -> Query:
    arguments, having = _LOWERED.get(name, ({}, None))
    columns = _columns(*question.columns, *_FILTER_COLUMNS)

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(question.ask(loans.derive(spark, sf_dir, *columns), chosen, **arguments))

    return run, over_loans(question.sql(where, having))


def _of_loans(columns: tuple[str, ...], ask: Callable[[DataFrame], DataFrame], sql: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(ask(loans.derive(spark, sf_dir, *columns)))

    return run, over_loans(sql)


def _union(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = loans.derive(spark, sf_dir)
    parts = [
        fact.where("program = '504'").drop("lender_name"),
        fact.where("program = '7A'").drop("cdc_name", "third_party_lender_name"),
    ]
    return plain(
        union_by_name(parts)
        .groupBy("program", "lender_name", "third_party_lender_name", "cdc_name")
        .agg(F.count(F.lit(1)).alias("total_loans"), F.sum("loan_amount").alias("amount"))
    )


def _doubled(fact: DataFrame) -> DataFrame:
    return fact.unionByName(fact)


def queries() -> dict[str, Query]:
    """All of them, by name."""
    found: dict[str, Query] = {}
    for name, question in {**QUESTIONS, **VIEW_QUESTIONS}.items():
        found[name] = _whole(question)
    for name, question in QUESTIONS.items():
        for suffix, (chosen, where) in _SLICES.items():
            found[f"{name}_{suffix}"] = _sliced(name, question, chosen, where)

    nowhere = LoanFilter("NOWHERE")
    found["c1_empty_slice"] = _of_loans(
        ("borrower_state", *_FOUR_COLUMNS),
        lambda fact: measures.overview(fact, nowhere),
        f"SELECT {FOUR} FROM loans WHERE borrower_state = 'NOWHERE'",
    )
    found["c7_is_empty_slice"] = _of_loans(
        ("borrower_state", *_FOUR_COLUMNS),
        lambda fact: is_empty_slice(measures.overview(fact, nowhere)).unionByName(
            is_empty_slice(measures.overview(fact))
        ),
        "SELECT COUNT(*) = 0 AS no_loans FROM loans WHERE borrower_state = 'NOWHERE' "
        "UNION ALL SELECT COUNT(*) = 0 FROM loans",
    )
    states = QUESTIONS["d7_state_funding"].sql()
    leading = f"{states} ORDER BY total_funding DESC NULLS FIRST, borrower_state"
    found["e5_top_states_chart_order"] = _of_loans(
        ("borrower_state", "loan_amount"),
        lambda fact: ranking.chart_order(
            measures.state_funding(fact).limit(10), "total_funding", "borrower_state"
        ),
        f"SELECT * FROM ({leading} LIMIT 10) AS ahead ORDER BY total_funding",
    )
    found["e6_top_state"] = _of_loans(
        ("borrower_state", "loan_amount"),
        lambda fact: ranking.first(measures.state_funding(fact)),
        f"{leading} LIMIT 1",
    )
    found["e9_head_of_states"] = _of_loans(
        ("borrower_state", "loan_amount"),
        lambda fact: ranking.head(measures.state_funding(fact)),
        f"{leading} LIMIT 3",
    )
    found["f1_union_by_name"] = (
        _union,
        over_loans(
            "SELECT program, lender_name, third_party_lender_name, cdc_name, "
            "COUNT(*) AS total_loans, CAST(SUM(loan_amount) AS DOUBLE) AS amount FROM ("
            "SELECT program, NULL AS lender_name, third_party_lender_name, cdc_name, loan_amount "
            "FROM loans WHERE program = '504' UNION ALL "
            "SELECT program, lender_name, NULL, NULL, loan_amount FROM loans WHERE program = '7A'"
            ") AS parts GROUP BY ALL"
        ),
    )
    measured = "SELECT COUNT(*) AS row_count, CAST(SUM(loan_id) AS BIGINT) AS id_sum, "
    measured += "CAST(SUM(loan_amount) AS DOUBLE) AS amount FROM "
    found["f2_drop_duplicates"] = _of_loans(
        (),
        lambda fact: cleaning.drop_duplicates(_doubled(fact)).agg(
            F.count(F.lit(1)).alias("row_count"),
            F.sum("loan_id").alias("id_sum"),
            F.sum("loan_amount").alias("amount"),
        ),
        measured + "(SELECT DISTINCT * FROM (SELECT * FROM loans UNION ALL SELECT * FROM loans))",
    )
    # A third of all rows or more are copies of a few: status, program and year.
    hot = ("program", "loan_status", "approval_fiscal_year")
    found["f2_drop_duplicates_hot_rows"] = _of_loans(
        hot, cleaning.drop_duplicates, f"SELECT DISTINCT {', '.join(hot)} FROM loans"
    )
    found["d21_duplicate_count"] = _of_loans(
        (),
        lambda fact: cleaning.duplicate_count(_doubled(fact)),
        "SELECT (SELECT COUNT(*) * 2 FROM loans) - (SELECT COUNT(*) FROM "
        "(SELECT DISTINCT * FROM loans)) AS duplicate_rows",
    )
    found["f3_states"] = _of_loans(
        ("borrower_state",),
        options.states,
        "SELECT DISTINCT borrower_state FROM loans WHERE borrower_state IS NOT NULL",
    )
    found["f4_fiscal_years"] = _of_loans(
        ("approval_fiscal_year",),
        options.fiscal_years,
        "SELECT DISTINCT approval_fiscal_year FROM loans WHERE approval_fiscal_year IS NOT NULL",
    )
    industries = (
        "SELECT DISTINCT naics_code, COALESCE(naics_description, 'Unknown') AS naics_description "
        "FROM loans WHERE naics_code IS NOT NULL"
    )
    found["f5_industries"] = _of_loans(
        ("naics_code", "naics_description"), options.industries, industries
    )
    found["f6_states_with_all"] = _of_loans(
        ("borrower_state",),
        lambda fact: options.with_all(options.states(fact), F.col("borrower_state")),
        "SELECT 0 AS position, 'All' AS option UNION ALL SELECT DISTINCT 1, borrower_state "
        "FROM loans WHERE borrower_state IS NOT NULL",
    )
    found["f6_fiscal_years_with_all"] = _of_loans(
        ("approval_fiscal_year",),
        lambda fact: options.with_all(options.fiscal_years(fact), F.col("approval_fiscal_year")),
        "SELECT 0 AS position, 'All' AS option UNION ALL SELECT DISTINCT 1, "
        "CAST(approval_fiscal_year AS VARCHAR) FROM loans WHERE approval_fiscal_year IS NOT NULL",
    )
    found["b18_industry_labels"] = _of_loans(
        ("naics_code", "naics_description"),
        options.industry_labels,
        f"SELECT naics_code, concat(naics_code, ' - ', naics_description) AS label "
        f"FROM ({industries}) AS industries",
    )
    found["d16_column_profile"] = _of_loans((), profiling.column_profile, _profile_sql())
    found["d17_null_percentages"] = _of_loans((), profiling.null_percentages, _nulls_sql())
    found["d18_numeric_stats"] = _of_loans(
        _NUMBERS, lambda fact: profiling.numeric_stats(fact, _NUMBERS), _stats_sql()
    )
    found["d18_quantiles_wide_bracket"] = _of_loans(
        _NUMBERS,
        lambda fact: profiling.quantiles(fact, _NUMBERS, _FRACTIONS, most=200),
        _quantiles_sql(),
    )
    found["d19_run_summary"] = _of_loans(
        (),
        lambda fact: profiling.run_summary(
            cleaning.copy_counts(_doubled(fact)), len(fact.columns)
        ),
        f"SELECT COUNT(*) AS row_count, {len(loans.COLUMNS)} AS column_count, "
        "(SELECT COUNT(*) * 2 FROM loans) - COUNT(*) AS duplicate_rows_removed "
        "FROM (SELECT DISTINCT * FROM loans) AS cleaned",
    )
    return found


_NUMBERS = (
    "loan_amount", "sba_guaranteed_approval", "charge_off_amount",
    "jobs_supported", "approval_fiscal_year",
)
_TYPES = {
    "loan_id": "bigint",
    "loan_amount": "decimal(18,2)",
    "sba_guaranteed_approval": "decimal(18,2)",
    "charge_off_amount": "decimal(18,2)",
    "jobs_supported": "int",
    "approval_date": "date",
    "approval_fiscal_year": "int",
    "as_of_date": "date",
}


# Quantiles that are found by several rounds, since few rows may be ordered at last.
_FRACTIONS = (0.01, 0.5, 0.99)


def _quantiles_sql() -> str:
    return _per_column(
        _NUMBERS,
        lambda c: f"'{c}' AS column_name, "
        + ", ".join(
            f"quantile_cont(CAST({c} AS DOUBLE), {q}) AS p{round(q * 100)}" for q in _FRACTIONS
        ),
    )


def _per_column(columns: tuple[str, ...] | list[str], line: Callable[[str], str]) -> str:
    return " UNION ALL ".join(f"SELECT {line(c)} FROM loans" for c in columns)


def _profile_sql() -> str:
    return _per_column(
        loans.COLUMNS,
        lambda c: f"'{c}' AS column_name, '{_TYPES.get(c, 'string')}' AS dtype, "
        f"COUNT(*) - COUNT({c}) AS missing_values",
    )


def _nulls_sql() -> str:
    return _per_column(
        loans.COLUMNS,
        lambda c: f"'{c}' AS column_name, "
        f"round_even(100.0 * (COUNT(*) - COUNT({c})) / COUNT(*), 2) AS null_percentage",
    )


def _stats_sql() -> str:
    def line(c: str) -> str:
        number = f"CAST({c} AS DOUBLE)"
        parts = ", ".join(
            f"round_even(round_even(quantile_cont({number}, {q}), 6), 2) AS p{round(q * 100)}"
            for q in profiling.QUARTILES
        )
        return (
            f"'{c}' AS column_name, COUNT({c}) AS count, "
            f"round_even(CAST(SUM({c}) AS DOUBLE) / COUNT({c}), 2) AS mean, "
            f"round_even(stddev_samp({number}), 2) AS std, round_even(MIN({number}), 2) AS min, "
            f"{parts}, round_even(MAX({number}), 2) AS max"
        )

    return _per_column(_NUMBERS, line)
