"""Aggregates: properties that SQL comparison does not show."""

from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from checks.loans import derive
from lendscope.operators import measures, options, ranking
from lendscope.operators.filters import LoanFilter
from lendscope.operators.measures import FACT_COLUMNS, Facets
from lendscope.plans.dashboard import dashboard

QUESTIONS = [
    (measures.overview, {}),
    (measures.state_funding, {}),
    (measures.industry_analysis, {}),
    (measures.loan_status, {}),
    (measures.charge_off_rate_by_sector, {"minimum_funding": 1}),
    (measures.average_loan_by_state, {"minimum_loans": 1}),
    (measures.guarantee_share_by_industry, {"minimum_loans": 1}),
    (measures.top_lenders, {"minimum_loans": 1}),
    (measures.jobs_per_million_by_state, {"minimum_funding": 1}),
    (measures.program_comparison, {}),
]


@pytest.mark.parametrize(("ask", "arguments"), QUESTIONS)
@pytest.mark.parametrize("chosen", [LoanFilter(), LoanFilter("NATION_3"), LoanFilter("NOWHERE")])
def test_one_pass_gives_the_same(loans, ask, arguments, chosen):
    facets = Facets(chosen.apply(loans.select(*FACT_COLUMNS)))
    assert ask(facets, **arguments).collect() == ask(loans, chosen, **arguments).collect()
    facets.release()


def test_facets_hold_a_slice_already(loans):
    with pytest.raises(ValueError):
        measures.overview(Facets(loans.select(*FACT_COLUMNS)), LoanFilter("NATION_3"))


def test_groups_add_up_to_the_whole(loans):
    whole = measures.overview(loans).first()
    by_state = measures.totals(loans.where("borrower_state is not null"), "borrower_state")
    unknown = measures.overview(loans.where("borrower_state is null")).first()
    added = by_state.agg(F.sum("total_funding").alias("f"), F.sum("total_loans").alias("n")).first()
    assert added.f + unknown.total_funding == whole.total_funding
    assert added.n + unknown.total_loans == whole.total_loans


def test_filters_and_thresholds_are_pushed_to_the_scan(spark, loans, tmp_path):
    from lendscope.operators import sinks

    path = str(tmp_path / "table")
    sinks.write_table_files(loans, path)
    table = sinks.read_table_files(spark, path)
    chosen = LoanFilter("NATION_3", 1998, "470018")
    plan = measures.state_funding(table, chosen)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(approval_fiscal_year" in plan
    assert "EqualTo(borrower_state,NATION_3)" in plan
    assert "EqualTo(naics_code,470018)" in plan
    schema = plan[plan.index("ReadSchema") :].splitlines()[0]
    assert schema.count(":") == 4  # ReadSchema: and three columns


def test_aggregates_hash_and_combine_before_the_shuffle(loans):
    plan = measures.guarantee_share_by_industry(loans)._jdf.queryExecution().executedPlan()
    text = plan.toString()
    assert "TakeOrderedAndProject" in text
    first = text[text.rindex("Exchange hashpartitioning") :]
    assert "HashAggregate" in first and "SortAggregate" not in first
    assert "partial_sum" in first


def test_ties_and_unknown_averages(spark):
    rows = [("B", None), ("A", None), ("D", Decimal("5.00")), ("C", Decimal("5.00"))]
    frame = spark.createDataFrame(rows, "borrower_state string, loan_amount decimal(18,2)")
    found = measures.average_loan_by_state(frame, minimum_loans=1).collect()
    assert [r.borrower_state for r in found] == ["A", "B", "C", "D"]
    assert [r.total_funding for r in found] == [0, 0, 5, 5]
    assert [r.average_loan_size for r in found] == [None, None, 5.0, 5.0]
    chart = ranking.chart_order(measures.average_loan_by_state(frame, minimum_loans=1),
                                "average_loan_size", "borrower_state")
    assert [r.borrower_state for r in chart.collect()] == ["C", "D", "A", "B"]


def test_no_funding(spark):
    rows = [("A", "11", Decimal(0), 3, None)]
    frame = spark.createDataFrame(
        rows,
        "borrower_state string, naics_code string, loan_amount decimal(18,2), "
        "jobs_supported int, charge_off_amount decimal(18,2)",
    )
    assert measures.jobs_per_dollar_view(frame).first().jobs_per_dollar is None
    sectors = measures.charge_off_rate_by_sector(frame, minimum_funding=0).first()
    assert sectors.charge_off_rate == 0
    assert measures.jobs_per_million_by_state(frame, minimum_funding=0).first().jobs_per_million == 0


def test_sums_do_not_overflow(spark):
    large = Decimal("9999999999999999.99")
    frame = spark.range(1000).select(
        F.lit("A").alias("borrower_state"), F.lit(large).cast("decimal(18,2)").alias("loan_amount")
    )
    assert measures.state_funding(frame).first().total_funding == large * 1000


def test_options(spark):
    rows = [("b", 2001, "2", None), ("a", 2000, "1", "x"), (None, None, None, "y"), ("a", 2000, "1", "z")]
    frame = spark.createDataFrame(
        rows,
        "borrower_state string, approval_fiscal_year int, naics_code string, "
        "naics_description string",
    )
    assert [r[0] for r in options.states(frame).collect()] == ["a", "b"]
    assert [r[0] for r in options.fiscal_years(frame).collect()] == [2000, 2001]
    assert [tuple(r) for r in options.industries(frame).collect()] == [
        ("1", "x"), ("1", "z"), ("2", "Unknown"),
    ]
    listed = options.with_all(options.states(frame), F.col("borrower_state")).collect()
    assert [r.option for r in listed] == ["All", "a", "b"]


def test_dashboard_reads_the_fact_once(spark, sf_dir):
    page = dashboard(derive(spark, sf_dir), LoanFilter(fiscal_year=1998))
    assert {name for name, frame in page.panels.items() if frame.isEmpty()} <= {
        "charge_off_rate_by_sector", "average_loan_by_state", "guarantee_share_by_industry",
        "top_lenders", "jobs_per_million_by_state",
    }
    plan = page.panels["state_funding"]._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" in plan
    assert [r.caption for r in page.caption.collect()] == ["Current slice: Year: 1998"]
    assert page.scope.first().total_loans == 6000
    page.release()
    assert dashboard(derive(spark, sf_dir)).caption.isEmpty()


def test_a_hot_group_is_combined_in_each_task(spark):
    rows = spark.range(0, 200_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, F.col("id").cast("string")).otherwise("hot").alias("lender_name"),
        F.lit(Decimal("1.00")).cast("decimal(18,2)").alias("loan_amount"),
    )
    found = measures.top_lenders(rows, minimum_loans=2).collect()
    assert [(r.lender_name, r.total_loans) for r in found] == [("hot", 133_333)]
