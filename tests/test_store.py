"""Stored totals and loads that are seen whole or not at all."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lendscope.operators.filters import NO_FILTER, LoanFilter
from lendscope.plans.dashboard import dashboard, kept_dashboard, panel_lines
from lendscope.plans.store import LoanStore

FILTERS = [
    NO_FILTER, LoanFilter(fiscal_year=1998), LoanFilter(state="NATION_3"),
    LoanFilter(state="NATION_3", fiscal_year=1996), LoanFilter(naics_code="110000"),
    LoanFilter("NATION_7", 1997, "720001"), LoanFilter(state="NOWHERE"),
]


@pytest.fixture(scope="module")
def store(spark, loans, tmp_path_factory):
    """A table of a first load and one that was added."""
    made = LoanStore(spark, str(tmp_path_factory.mktemp("store")))
    early = F.col("approval_fiscal_year") < 1996
    made.refresh(loans.where(early))
    made.add(loans.where(~early | F.isnull("approval_fiscal_year")))
    return made


def rows(df):
    return sorted(
        tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in df.collect()
    )


@pytest.mark.parametrize("chosen", FILTERS)
def test_a_page_from_totals_equals_one_from_loans(store, loans, chosen):
    expected, page = dashboard(loans, chosen), kept_dashboard(store.totals(), chosen)
    assert rows(panel_lines(page)) == rows(panel_lines(expected))
    assert rows(page.findings) == rows(expected.findings)
    assert rows(page.caption) == rows(expected.caption)
    expected.release()


def test_scope_and_options_from_totals(store, loans):
    expected, page = dashboard(loans), kept_dashboard(store.totals(), FILTERS[3])
    for part in ("scope", "states", "fiscal_years", "industries"):
        assert rows(getattr(page, part)) == rows(getattr(expected, part))


def test_a_page_reads_one_cut_and_no_loans(store):
    page = kept_dashboard(store.totals(), LoanFilter(state="NATION_3"))
    for panel in (*page.panels.values(), page.scope, page.states, page.industries):
        plan = panel._jdf.queryExecution().executedPlan().toString()
        assert "loan_amount" not in plan and "/loans" not in plan
        assert "PartitionFilters: [isnotnull(cut" in plan


def test_filters_reach_the_totals(store):
    page = kept_dashboard(store.totals(), LoanFilter(state="NATION_3"))
    plan = page.panels["top_lenders"]._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(borrower_state,NATION_3)" in plan


def test_readers_see_whole_loads_only(spark, loans, tmp_path):
    made = LoanStore(spark, str(tmp_path / "table"))
    with pytest.raises(ValueError, match="no load"):
        made.loans()
    part = loans.where("approval_fiscal_year = 1997")
    made.refresh(part)
    size, open_page = part.count(), made.loans()
    broken = F.when(F.col("loan_id") % 500 == 7, F.raise_error(F.lit("lost"))).otherwise(
        F.col("lender_name")
    )
    with pytest.raises(Exception, match="lost"):
        made.refresh(loans.withColumn("lender_name", broken))
    assert made.loans().count() == size and len(made.loads()) == 1
    made.refresh(loans)
    assert open_page.count() == size, "a page that was open before still reads its own load"
    assert made.loans().count() == loans.count()
    assert kept_dashboard(made.totals()).scope.head().total_loans == loans.count()


def test_a_failed_addition_and_its_repeat_count_once(spark, loans, tmp_path, monkeypatch):
    made = LoanStore(spark, str(tmp_path / "table"))
    part = loans.where("approval_fiscal_year = 1997")
    made.refresh(part)
    with monkeypatch.context() as patched:
        patched.setattr(LoanStore, "_switch", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(OSError):
            made.add(part)
    assert made.loans().count() == part.count()
    made.add(part)
    assert made.loans().count() == 2 * part.count() == (
        kept_dashboard(made.totals()).scope.head().total_loans
    )
