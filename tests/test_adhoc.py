"""Guarded ad-hoc SQL and response logs."""

from __future__ import annotations

import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lendscope.operators import adhoc, display, responses, views
from lendscope.operators.filters import LoanFilter

VERDICTS = {
    "SELECT * FROM vw_state_funding ORDER BY total_funding DESC LIMIT 20;": adhoc.OK,
    "": adhoc.NO_QUERY,
    " ;; ": adhoc.NO_QUERY,
    "EXPLAIN SELECT 1": adhoc.NOT_SELECT,
    "SELECT 1; SELECT 2": adhoc.MANY_STATEMENTS,
    "SELECT 1 FROM vw_state_funding; ;": adhoc.MANY_STATEMENTS,
    "SELECT * FROM loans": adhoc.BLOCKED,
    "SELECT * FROM LOANS": adhoc.BLOCKED,
    "SELECT total_loans FROM vw_state_funding": adhoc.OK,
    "SELECT 1": adhoc.NO_VIEW,
    "SELECT * FROM other_table": adhoc.OTHER_RELATION,
    "WITH c AS (SELECT * FROM vw_state_funding) SELECT * FROM c": adhoc.OTHER_RELATION,
    "SELECT * FROM vw_state_funding, other_table": adhoc.OK,
    "selected FROM vw_state_funding": adhoc.OK,
    "SELECT a FROM\n vw_state_funding": adhoc.OK,
}

REFUSED = [
    "SELECT * FROM vw_state_funding, other_table",
    "SELECT * FROM other_table",
    "SELECT 1",
    "SELECT * FROM range(5)",
    "SELECT (SELECT max(1) FROM other_table) FROM vw_state_funding",
    "SELECT * FROM vw_state_funding WHERE EXISTS (SELECT 1 FROM other_table)",
    "SELECT * FROM vw_state_funding WHERE 1 IN (SELECT 1 FROM other_table)",
    "WITH c AS (SELECT * FROM other_table) SELECT * FROM c",
    "WITH c AS (WITH d AS (SELECT * FROM other_table) SELECT * FROM d) SELECT * FROM c",
    "WITH other_table AS (SELECT * FROM vw_state_funding) SELECT * FROM other_table",
    "WITH vw_state_funding AS (SELECT 1) SELECT * FROM vw_state_funding",
    "SELECT * FROM vw_state_funding UNION SELECT * FROM other_table",
    "SELECT * FROM parquet.`/etc`",
    "SELECT * FROM default.vw_state_funding",
    "SELECT * FROM IDENTIFIER('other_' || 'table')",
    "SELECT IDENTIFIER('reflect')('java.lang.System', 'exit') FROM vw_state_funding",
    "SELECT reflect('java.lang.System', 'currentTimeMillis') FROM vw_state_funding",
    "SELECT upper(try_reflect('a', 'b')) FROM vw_state_funding",
    "SELECT TRANSFORM(borrower_state) USING 'cat' FROM vw_state_funding",
    "SELECT FROM vw_state_funding GROUP",
    "VALUES (1)",
    "DROP TABLE x",
    "",
]

ALLOWED = [
    "SELECT * FROM vw_state_funding;",
    "WITH c AS (SELECT * FROM vw_state_funding) SELECT * FROM c",
    "WITH c AS (SELECT * FROM vw_state_funding), d AS (SELECT * FROM c) SELECT count(*) FROM d",
    "SELECT extract(YEAR FROM current_date()) FROM vw_jobs_per_dollar",
    "SELECT a.* FROM vw_state_funding a, vw_jobs_per_dollar b",
    "SELECT borrower_state, rank() OVER (ORDER BY total_funding) FROM VW_STATE_FUNDING",
    "SELECT loan_status, sum(total_funding) FROM vw_loan_status_summary GROUP BY 1 HAVING sum(1) > 0",
    "SELECT * FROM vw_state_funding WHERE total_loans > (SELECT avg(total_loans) FROM vw_state_funding)",
]


@pytest.fixture(scope="module", autouse=True)
def registered(spark, loans):
    views.create_views(loans)
    spark.range(1).createOrReplaceTempView("other_table")


def test_verdicts(spark):
    log = spark.createDataFrame(list(enumerate(VERDICTS)), "id int, sql string")
    rows = adhoc.review(log).orderBy("id").collect()
    assert [r.verdict for r in rows] == list(VERDICTS.values())
    assert rows[0].query.endswith("LIMIT 20")
    assert rows[-1].relations == ["vw_state_funding"]
    assert adhoc.review(spark.createDataFrame([(None,)], "sql string")).first().verdict == adhoc.NO_QUERY


@pytest.mark.parametrize("query", REFUSED)
def test_refused(spark, query):
    with pytest.raises(adhoc.RefusedQuery):
        adhoc.guarded_sql(spark, query)


@pytest.mark.parametrize("query", ALLOWED)
def test_allowed(spark, query):
    assert adhoc.guarded_sql(spark, query).count() > 0


def test_views_have_the_documented_columns(loans):
    found: dict[str, list[str]] = {}
    for row in views.view_columns(loans).collect():
        found.setdefault(row.view_name, []).append(row.column_name)
    assert found["vw_loan_status_summary"] == [
        "loan_status", "total_loans", "total_funding", "total_charge_off_amount",
    ]
    assert len(found) == 4


def test_result_preview(spark):
    frame = spark.createDataFrame([("a", Decimal("1.50")), ("b", None)], "k string, v decimal(9,2)")
    text = adhoc.result_preview(frame.orderBy("k")).first().summary
    assert text == "Returned 2 row(s). Top rows: [{'k': 'a', 'v': 1.5}, {'k': 'b', 'v': None}]"
    assert adhoc.result_preview(frame.where("false")).first().summary.endswith("returned no rows.")
    assert adhoc.result_preview(frame.select("k").limit(1)).first().summary == "k: a"


def test_shapes(spark):
    frame = spark.createDataFrame([("x", "2"), ("y", None), ("z", "q"), (None, "1")], "k string, v string")
    assert [r.value for r in adhoc.bar_shape(frame).collect()] == ["1", "2", "q", None]
    assert [r.value for r in adhoc.pie_shape(frame).collect()] == [2.0, None, None, 1.0]


def body(*texts, kind="message"):
    content = [{"type": "output_text", "text": t} for t in texts]
    return json.dumps({"output": [{"type": kind, "content": content}]})


RESPONSES = [
    (body("a", "b"), "a\nb", "bad json"),
    (body("x", kind="reasoning"), "", "empty"),
    (body("", " {} "), "{}", "unsupported"),
    ("{}", "", "empty"),
    ("junk", "", "empty"),
    (None, "", "empty"),
    ('{"output": [{"type": "message"}]}', "", "empty"),
    (body('{"can_answer": true, "sql": "s"}'), None, "answered"),
    (body('```json\n{"can_answer": true}\n```'), None, "answered"),
    (body('```\n{"can_answer": "yes"}```'), None, "answered"),
    (body('{"can_answer": 0}'), None, "unsupported"),
    (body('{"can_answer": null}'), None, "unsupported"),
    (body('{"can_answer": true} tail'), None, "bad json"),
    (body('{"can_answer": true}, {"a": 1}'), None, "bad json"),
    (body("{'can_answer': true}"), None, "bad json"),
    (body("null"), None, "bad json"),
    (body("[1]"), None, "bad json"),
]


def test_responses(spark):
    log = spark.createDataFrame([(i, b) for i, (b, _, _) in enumerate(RESPONSES)], "id int, body string")
    rows = responses.answers(log).orderBy("id").collect()
    assert [r.status for r in rows] == [s for _, _, s in RESPONSES]
    for row, (_, text, _) in zip(rows, RESPONSES):
        assert text is None or row.text == text
    answered = rows[7]
    assert (answered.sql, answered.answer_title, answered.chart_type, answered.notes) == (
        "s", "Ask the Data", "table", None,
    )
    refused = rows[10]
    assert (refused.sql, refused.answer_title, refused.chart_type) == (
        "", "Question not supported", "table",
    )
    assert refused.notes.startswith("This question could not")


def test_captions(spark, loans):
    found = display.slice_caption(loans, LoanFilter("NATION_3", 1998, "no such code")).collect()
    assert [r.caption for r in found] == [
        "Current slice: State: NATION_3 | Year: 1998 | Industry: no such code"
    ]


def test_scope_note_without_dates(spark):
    frame = spark.createDataFrame(
        [("7A", 2020, None)], "program string, approval_fiscal_year int, as_of_date date"
    )
    note = display.scope_note(frame).first().note
    assert note == "7A loans from fiscal years 2020-2020. Latest extract date: Unknown."


def test_bound_parameters_are_values(spark):
    text = "x' OR '1'='1"
    found = adhoc.read_sql(spark, "SELECT :v AS v", {"v": text}).select(F.col("v")).first()
    assert found.v == text
