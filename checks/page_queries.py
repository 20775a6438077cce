"""Ad-hoc SQL, response logs, and what a reader sees."""

from __future__ import annotations

from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import loans
from checks.measure_queries import QUESTIONS, VIEW_QUESTIONS, Query, over_loans
from checks.results import plain
from lendscope.model import BLOCKED_WORDS
from lendscope.operators import adhoc, display, measures, responses, views
from lendscope.operators.filters import LoanFilter
from lendscope.plans.dashboard import dashboard, kept_dashboard, panel_lines
from lendscope.plans.store import LoanStore
from lendscope.session import scratch_path, sized_shuffles

# A log of ad-hoc queries, one per event, in SQL that both dialects take.  The
# kinds of text are those the rules tell apart.
_ID = "CAST(event_id AS VARCHAR(20))"
_LOG_TEXT = (
    "CASE mod(event_id, 14) "
    f"WHEN 0 THEN concat('SELECT * FROM vw_state_funding ORDER BY total_funding DESC LIMIT ', {_ID}, ';') "
    "WHEN 1 THEN '  ' "
    "WHEN 2 THEN 'EXPLAIN SELECT 1' "
    f"WHEN 3 THEN concat('SELECT ', {_ID}, '; SELECT 2') "
    f"WHEN 4 THEN concat('SELECT * FROM loans WHERE loan_id = ', {_ID}) "
    "WHEN 5 THEN concat(' SELECT total_loans', chr(10), 'FROM', chr(10), 'vw_state_funding ;; ') "
    f"WHEN 6 THEN concat('SELECT ', {_ID}) "
    f"WHEN 7 THEN concat('SELECT * FROM table_', {_ID}) "
    "WHEN 8 THEN 'WITH c AS (SELECT * FROM vw_state_funding) SELECT * FROM c' "
    "WHEN 9 THEN 'SELECT * FROM vw_state_funding, other_table' "
    "WHEN 10 THEN 'select a.* from VW_Industry_Funding a JOIN vw_jobs_per_dollar b ON 1 = 1' "
    "WHEN 11 THEN concat('SELECT ''', event_type, ''' FROM vw_loan_status_summary; ;') "
    "WHEN 12 THEN concat('WITH x AS (SELECT 1) DROP TABLE t_', event_type) "
    f"ELSE concat('SELECT updated, {'{'}0{'}'} FROM vw_state_funding WHERE total_loans > ', {_ID}) END"
).replace("{0}", "created")

_ALLOWED_SQL = "['" + "', '".join(sorted(views.VIEWS)) + "']"
_REVIEW_SQL = f"""
WITH log AS (SELECT event_id, {_LOG_TEXT} AS text FROM events),
queries AS (SELECT event_id, trim(rtrim(trim(text, chr(32)||chr(10)), ';'), chr(32)||chr(10))
            AS query FROM log),
named AS (SELECT *, list_sort(list_distinct(regexp_extract_all(lower(query),
            '\\b(?:from|join)\\s+([a-z_][a-z0-9_]*)', 1))) AS names FROM queries),
others AS (SELECT *, list_sort(list_filter(names, lambda n: NOT list_contains({_ALLOWED_SQL}, n)))
            AS other_names FROM named)
SELECT event_id, query, array_to_string(names, ',') AS relations,
  array_to_string(other_names, ',') AS disallowed,
  CASE WHEN query = '' THEN 'no query'
       WHEN NOT regexp_matches(lower(query), '^(select|with)') THEN 'only SELECT'
       WHEN contains(query, ';') THEN 'single statement'
       WHEN regexp_matches(lower(query), '\\b({'|'.join(BLOCKED_WORDS)})\\b') THEN 'blocked word'
       WHEN len(names) = 0 THEN 'no view referenced'
       WHEN len(other_names) > 0 THEN 'disallowed relation'
       ELSE 'ok' END AS verdict
FROM others
"""


def _review(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = loans.table(spark, sf_dir, "events").select(
        "event_id", F.expr(_LOG_TEXT).alias("text")
    )
    return adhoc.review(log, "text").select(
        "event_id",
        "query",
        F.array_join("relations", ",").alias("relations"),
        F.array_join("disallowed", ",").alias("disallowed"),
        "verdict",
    )


# A log of model responses, one per event.  The inner JSON is escaped to stand in
# a string of the outer one.
_QUOTED = "replace({}, '\"', concat(chr(92), '\"'))"
_QUERY = "SELECT * FROM vw_state_funding WHERE total_loans > "
_PAYLOAD_TEXT = (
    "CASE mod(event_id, 8) "
    f"WHEN 0 THEN concat('{{\"can_answer\": true, \"sql\": \"{_QUERY}', {_ID}, "
    "'\", \"answer_title\": \"', event_type, '\", \"chart_type\": \"bar\", \"notes\": \"n\"}') "
    f"WHEN 1 THEN concat('```json', chr(92), 'n{{\"can_answer\": true, \"sql\": \"{_QUERY}', {_ID}, "
    "'\"}', chr(92), 'n```') "
    f"WHEN 2 THEN concat('{{\"can_answer\": false, \"notes\": \"no ', event_type, '\"}}') "
    "WHEN 3 THEN '{\"sql\": \"SELECT 1\", \"answer_title\": \"t\", \"chart_type\": \"pie\"}' "
    "WHEN 4 THEN concat('I cannot say, ', event_type) "
    "WHEN 5 THEN '{\"can_answer\": true} and more' "
    "WHEN 6 THEN '' "
    "ELSE '[1, 2]' END"
)
_BODY_TEXT = (
    "concat('{\"id\": ', CAST(event_id AS VARCHAR(20)), ', \"output\": ["
    '{"type": "reasoning", "content": [{"type": "output_text", "text": "hidden"}]}, '
    '{"type": "message", "content": [{"type": "refusal", "text": "x"}, '
    "{\"type\": \"output_text\", \"text\": \"', " + _QUOTED.format(_PAYLOAD_TEXT) + ", '\"}, "
    '{"type": "output_text", "text": ""}]}, {"type": "message"}]}\')'
)
_NO_ANSWER = responses.UNSUPPORTED_NOTES
_ANSWERS_SQL = f"""
SELECT event_id,
  CASE mod(event_id, 8)
    WHEN 6 THEN '' WHEN 1 THEN replace({_PAYLOAD_TEXT}, concat(chr(92), 'n'), chr(10))
    ELSE {_PAYLOAD_TEXT} END AS text,
  CASE WHEN mod(event_id, 8) IN (0, 1) THEN 'answered'
       WHEN mod(event_id, 8) IN (2, 3) THEN 'unsupported'
       WHEN mod(event_id, 8) = 6 THEN 'empty' ELSE 'bad json' END AS status,
  CASE WHEN mod(event_id, 8) IN (0, 1) THEN concat('{_QUERY}', {_ID})
       WHEN mod(event_id, 8) IN (2, 3) THEN '' END AS sql,
  CASE mod(event_id, 8) WHEN 0 THEN event_type WHEN 1 THEN '{responses.DEFAULT_TITLE}'
       WHEN 2 THEN '{responses.UNSUPPORTED_TITLE}' WHEN 3 THEN 't' END AS answer_title,
  CASE mod(event_id, 8) WHEN 0 THEN 'n' WHEN 2 THEN concat('no ', event_type)
       WHEN 3 THEN '{_NO_ANSWER}' END AS notes,
  CASE mod(event_id, 8) WHEN 0 THEN 'bar' WHEN 1 THEN 'table' WHEN 2 THEN 'table'
       WHEN 3 THEN 'table' END AS chart_type
FROM events
"""


def _answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = loans.table(spark, sf_dir, "events").select(
        "event_id", F.expr(_BODY_TEXT).alias("body")
    )
    return responses.answers(log).drop("body")


def _guarded(query: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        views.create_views(loans.derive(spark, sf_dir))
        return plain(adhoc.guarded_sql(spark, query))

    return run


_STATES = VIEW_QUESTIONS["d3_state_view"].sql()
_CTE = (
    "WITH large AS (SELECT borrower_state, total_loans FROM vw_state_funding "
    "WHERE total_loans > 100) SELECT borrower_state, total_loans FROM large "
    "ORDER BY total_loans DESC, borrower_state LIMIT 5;"
)


def _preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    views.create_views(loans.derive(spark, sf_dir))
    leading = "SELECT borrower_state, total_loans FROM vw_state_funding "
    result = adhoc.guarded_sql(spark, leading + "ORDER BY total_loans DESC, borrower_state")
    return adhoc.result_preview(result)


_PREVIEW_SQL = over_loans(
    f"""
, states AS ({_STATES}),
ahead AS (SELECT *, row_number() OVER (ORDER BY total_loans DESC, borrower_state) AS place
            FROM states)
SELECT (SELECT COUNT(*) FROM states) AS row_count, 2 AS column_count,
  concat('Returned ', (SELECT COUNT(*) FROM states), ' row(s). Top rows: [',
    string_agg(concat('{{''borrower_state'': ''', borrower_state, ''', ''total_loans'': ',
               total_loans, '}}'), ', ' ORDER BY place), ']') AS summary
FROM ahead WHERE place <= 3
"""
).replace(") \n,", "),\n", 1)


def _bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = loans.derive(spark, sf_dir, "borrower_state", "loan_amount", "jobs_supported")
    return plain(adhoc.bar_shape(measures.state_view(fact)))


def _pie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adhoc.pie_shape(measures.loan_status(loans.derive(spark, sf_dir, "loan_status")))


def _pie_of_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = loans.derive(spark, sf_dir, "loan_id", "loan_status")
    return adhoc.pie_shape(fact.select("loan_id", "loan_status"))


def _money(number: str) -> str:
    return f"format('${{:,}}', CAST(round_even(COALESCE({number}, 0), 0) AS BIGINT))"


def _count(number: str) -> str:
    return f"format('{{:,}}', CAST(COALESCE({number}, 0) AS BIGINT))"


def _on(name: str, show: Callable[[DataFrame], DataFrame], select: str) -> Query:
    question = QUESTIONS[name]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(show(question.ask(loans.derive(spark, sf_dir, *question.columns))))

    return run, over_loans(f"SELECT {select} FROM ({question.sql()}) AS answer")


def _overview_sql() -> str:
    shown = {
        "Total Loans": _count("total_loans"),
        "Total Funding": _money("total_funding"),
        "Average Loan Size": _money("average_loan_size"),
        "Jobs Supported": _count("total_jobs_supported"),
    }
    overview = QUESTIONS["d1_overview"].sql()
    return over_loans(
        ", answer AS ("
        + overview
        + ") "
        + " UNION ALL ".join(
            f"SELECT '{name}' AS metric, {text} AS value FROM answer"
            for name, text in shown.items()
        )
    ).replace(") , answer", "), answer", 1)


_SLICE = LoanFilter("NATION_3", 1998, "470018")
_CAPTION_SQL = over_loans(
    "SELECT concat('Current slice: State: NATION_3 | Year: 1998 | Industry: ', "
    "COALESCE(MAX(concat(naics_code, ' - ', COALESCE(naics_description, 'Unknown'))), '470018')) "
    "AS caption FROM loans WHERE naics_code = '470018'"
)


def _caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    return display.slice_caption(
        loans.derive(spark, sf_dir, "naics_code", "naics_description"), _SLICE
    )


def _scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = loans.derive(spark, sf_dir, "program", "approval_fiscal_year", "as_of_date")
    return display.scope_note(fact)


_SCOPE_SQL = over_loans(
    "SELECT program, concat(program, ' loans from fiscal years ', MIN(approval_fiscal_year), '-', "
    "MAX(approval_fiscal_year), '. Latest extract date: ', "
    "strftime(MAX(as_of_date), '%B %d, %Y'), '.') AS note FROM loans GROUP BY program"
)

_CARD_SQL = {
    "d7_state_funding": (
        "borrower_state",
        f"concat({_money('total_funding')}, ' in approved funding.')",
        "total_funding DESC NULLS FIRST, borrower_state",
    ),
    "d8_industry_analysis": (
        "naics_description",
        f"concat({_money('total_funding')}, ' across ', {_count('total_loans')}, ' loans.')",
        "total_funding DESC NULLS FIRST, naics_code",
    ),
    "d10_charge_off_by_sector": (
        "sector",
        "concat(printf('%.1f', round_even(charge_off_rate * 100, 1)), '% charge-off rate on ', "
        f"{_money('total_funding')}, '.')",
        "charge_off_rate DESC NULLS FIRST, total_charge_off_amount DESC NULLS FIRST, sector",
    ),
    "d13_top_lenders": (
        "lender_name",
        f"concat({_money('total_funding')}, ' across ', {_count('total_loans')}, ' loans.')",
        "total_funding DESC NULLS FIRST, lender_name",
    ),
}


def _findings_sql(where: str | None) -> str:
    cards = []
    for (position, label, nothing), (name, (value, note, order)) in zip(
        display._CARDS, _CARD_SQL.items()
    ):
        leader = (
            f"SELECT {value} AS value, {note} AS note FROM ({QUESTIONS[name].sql(where)}) AS a "
            f"ORDER BY {order} LIMIT 1"
        )
        cards.append(
            f"SELECT {position} AS position, '{label}' AS label, "
            f"COALESCE(MAX(value), 'No data') AS value, COALESCE(MAX(note), '{nothing}') AS note "
            f"FROM ({leader}) AS leader"
        )
    return over_loans(" UNION ALL ".join(cards))


def _findings(chosen: LoanFilter) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return dashboard(loans.derive(spark, sf_dir), chosen).findings

    return run


def _dashboard(chosen: LoanFilter) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return panel_lines(dashboard(loans.derive(spark, sf_dir), chosen))

    return run


@lru_cache(maxsize=8)
def _store_path(application: str, spark: SparkSession, sf_dir: str) -> str:
    """A table of two loads, the second one added to the first."""
    store = LoanStore(spark, scratch_path(spark, "loan-store"))
    fact = loans.derive(spark, sf_dir)
    odd = F.col("loan_id") % 2 == 1
    with sized_shuffles(spark, loans.joined_bytes(spark, sf_dir)):
        store.refresh(fact.where(odd))
        store.add(fact.where(~odd))
    return store.path


def _store(spark: SparkSession, sf_dir: str) -> LoanStore:
    return LoanStore(spark, _store_path(spark.sparkContext.applicationId, spark, sf_dir))


def _kept_dashboard(chosen: LoanFilter) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return panel_lines(kept_dashboard(_store(spark, sf_dir).totals(), chosen))

    return run


def _refreshed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per load's year after a refresh took the place of other rows."""
    store = LoanStore(spark, scratch_path(spark, "refreshed-loans"))
    fact = loans.derive(spark, sf_dir)
    store.refresh(fact.where("loan_id % 3 = 0"))
    store.refresh(fact)
    found = store.loans().groupBy("approval_fiscal_year", "loan_status").agg(
        F.count(F.lit(1)).alias("total_loans"), F.sum("loan_amount").alias("amount")
    )
    return plain(found)


_PANELS = {
    "d1_overview": ("overview", "'All'", "total_funding"),
    "d7_state_funding": ("state_funding", "borrower_state", "total_funding"),
    "d8_industry_analysis": ("industry_analysis", "naics_code", "total_funding"),
    "d9_loan_status": ("loan_status", "loan_status", "total_loans"),
    "d10_charge_off_by_sector": ("charge_off_rate_by_sector", "sector", "charge_off_rate"),
    "d11_average_by_state": ("average_loan_by_state", "borrower_state", "average_loan_size"),
    "d12_guarantee_share": ("guarantee_share_by_industry", "naics_code", "guarantee_share"),
    "d13_top_lenders": ("top_lenders", "lender_name", "total_funding"),
    "d14_jobs_per_million": ("jobs_per_million_by_state", "borrower_state", "jobs_per_million"),
    "d15_program_comparison": ("program_comparison", "program", "total_funding"),
}


def _dashboard_sql(where: str | None) -> str:
    return over_loans(
        " UNION ALL ".join(
            f"SELECT '{panel}' AS panel, {item} AS item, CAST({value} AS DOUBLE) AS value "
            f"FROM ({QUESTIONS[name].sql(where)}) AS {panel}"
            for name, (panel, item, value) in _PANELS.items()
        )
    )


def queries() -> dict[str, Query]:
    """All of them, by name."""
    year = LoanFilter(fiscal_year=1998)
    in_year = "approval_fiscal_year = 1998"
    return {
        "b19_scope_note": (_scope, _SCOPE_SQL),
        "b20_overview_metrics": (
            _on("d1_overview", display.overview_metrics, "*")[0],
            _overview_sql(),
        ),
        "b20_industry_table": _on(
            "d8_industry_analysis",
            display.industry_table,
            f"naics_code, naics_description, {_count('total_loans')} AS total_loans, "
            f"{_money('total_funding')} AS total_funding",
        ),
        "b20_lender_table": _on(
            "d13_top_lenders",
            display.lender_table,
            f"lender_name, {_count('total_loans')} AS total_loans, "
            f"{_money('total_funding')} AS total_funding, "
            f"{_money('average_loan_size')} AS average_loan_size",
        ),
        "b21_program_cards": _on(
            "d15_program_comparison",
            display.program_cards,
            f"concat(program, ' Program') AS label, {_money('total_funding')} AS value, "
            f"concat({_count('total_loans')}, ' loans | Avg ', {_money('average_loan_size')}, "
            f"' | ', {_count('total_jobs_supported')}, ' jobs') AS note",
        ),
        "b22_slice_caption": (_caption, _CAPTION_SQL),
        "g2_query_review": (_review, _REVIEW_SQL),
        "g3_guarded_query": (
            _guarded("SELECT * FROM vw_state_funding ORDER BY total_funding DESC LIMIT 100;"),
            over_loans(_STATES),
        ),
        "g3_guarded_cte": (
            _guarded(_CTE),
            over_loans(
                f"SELECT borrower_state, total_loans FROM ({_STATES}) AS s WHERE total_loans > 100 "
                "ORDER BY total_loans DESC, borrower_state LIMIT 5"
            ),
        ),
        "g4_result_preview": (_preview, _PREVIEW_SQL),
        "g5_bar_shape": (
            _bars,
            over_loans(
                f"SELECT borrower_state AS label, total_loans AS value FROM ({_STATES}) AS s"
            ),
        ),
        "g6_pie_shape": (
            _pie,
            over_loans(
                "SELECT COALESCE(loan_status, 'Unknown') AS label, "
                "CAST(COUNT(*) AS DOUBLE) AS value FROM loans GROUP BY 1"
            ),
        ),
        "g6_pie_shape_of_texts": (
            _pie_of_texts,
            over_loans(
                "SELECT CAST(loan_id AS VARCHAR) AS label, TRY_CAST(loan_status AS DOUBLE) "
                "AS value FROM loans"
            ),
        ),
        "g7_g8_g9_answers": (_answers, _ANSWERS_SQL),
        "h5_dashboard": (_dashboard(LoanFilter()), _dashboard_sql(None)),
        "h5_dashboard_in_year": (_dashboard(year), _dashboard_sql(in_year)),
        "h5_kept_dashboard": (_kept_dashboard(LoanFilter()), _dashboard_sql(None)),
        "h5_kept_dashboard_in_year": (_kept_dashboard(year), _dashboard_sql(in_year)),
        "h5_kept_dashboard_in_state_year": (
            _kept_dashboard(LoanFilter(state="NATION_3", fiscal_year=1998)),
            _dashboard_sql(f"{in_year} AND borrower_state = 'NATION_3'"),
        ),
        "a12_full_refresh": (
            _refreshed,
            over_loans(
                "SELECT approval_fiscal_year, loan_status, COUNT(*) AS total_loans, "
                "CAST(SUM(loan_amount) AS DOUBLE) AS amount FROM loans GROUP BY 1, 2"
            ),
        ),
        "h6_key_findings": (_findings(LoanFilter()), _findings_sql(None)),
        "h6_key_findings_in_year": (_findings(year), _findings_sql(in_year)),
        "h6_key_findings_nowhere": (
            _findings(LoanFilter("NOWHERE")),
            _findings_sql("borrower_state = 'NOWHERE'"),
        ),
    }
