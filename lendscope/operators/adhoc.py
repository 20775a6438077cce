"""Ad-hoc SQL limited to the views, in bulk and one query at a time."""

from __future__ import annotations

from collections.abc import Collection, Iterator
from decimal import Decimal
from typing import Any

from py4j.java_gateway import JavaObject
from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.functions.cells import strip
from lendscope.model import BLOCKED_WORDS, RESULT_PREVIEW_ROWS
from lendscope.operators.views import VIEWS

# (?U): white space and word ends as in any script.
_BLOCKED = rf"(?U)\b({'|'.join(BLOCKED_WORDS)})\b"
_RELATION = r"(?U)\b(?:from|join)\s+([a-z_][a-z0-9_]*)"

OK = "ok"
NO_QUERY = "no query"
NOT_SELECT = "only SELECT"
MANY_STATEMENTS = "single statement"
BLOCKED = "blocked word"
NO_VIEW = "no view referenced"
OTHER_RELATION = "disallowed relation"


class RefusedQuery(ValueError):
    """An ad-hoc query that is not a read of the allowed views."""


def read_sql(spark: SparkSession, query: str, params: dict[str, Any] | None = None) -> DataFrame:
    """Run SQL with named parameters, which are bound and never pasted in."""
    return spark.sql(query, args=params or {})


def normalized_query(text: Column) -> Column:
    """The query without outer white space and closing semicolons."""
    return strip(F.rtrim(strip(F.coalesce(text, F.lit(""))), F.lit(";")))


def _text_reason(query: Column) -> Column:
    """The first text rule that a normalized query breaks; null for none."""
    lowered = F.lower(query)
    return (
        F.when(query == "", F.lit(NO_QUERY))
        .when(~(lowered.startswith("select") | lowered.startswith("with")), F.lit(NOT_SELECT))
        .when(F.contains(query, F.lit(";")), F.lit(MANY_STATEMENTS))
        .when(lowered.rlike(_BLOCKED), F.lit(BLOCKED))
    )


def review(log: DataFrame, text: str = "sql", allowed: Collection[str] = tuple(VIEWS)) -> DataFrame:
    """A verdict for every query of a log.

    Adds the normalized query, the relations it names, those not allowed, and
    ``ok`` or the first rule broken.  A projection: each row on its own.
    """
    query = F.col("query")
    relations = F.array_sort(
        F.array_distinct(F.regexp_extract_all(F.lower(query), F.lit(_RELATION), F.lit(1)))
    )
    others = F.array_except("relations", F.array(*[F.lit(a) for a in sorted(allowed)]))
    verdict = (
        F.when(F.size("relations") == 0, F.lit(NO_VIEW))
        .when(F.size("disallowed") > 0, F.lit(OTHER_RELATION))
        .otherwise(F.lit(OK))
    )
    return (
        log.withColumn("query", normalized_query(F.col(text)))
        .withColumn("relations", relations)
        .withColumn("disallowed", others)
        .withColumn("verdict", F.coalesce(_text_reason(query), verdict))
    )


# Steps of Spark's own parse of a query that only read and reshape rows.
_READING_STEPS = frozenset(
    "Aggregate CTERelationRef Distinct Except Filter Generate GlobalLimit Intersect Join "
    "LateralJoin LocalLimit LocalRelation Offset OneRowRelation Pivot Project Sort "
    "SubqueryAlias Tail Union UnresolvedHaving UnresolvedInlineTable UnresolvedRelation "
    "UnresolvedSubqueryColumnAliases UnresolvedWith Unpivot WithWindowDefinition".split()
)
# Functions that call code by name.
_CODE_CALLS = frozenset({"reflect", "java_method", "try_reflect"})


def _each(items: JavaObject) -> Iterator[JavaObject]:
    step = items.iterator()
    while step.hasNext():
        yield step.next()


def _expressions(plan: JavaObject) -> Iterator[JavaObject]:
    waiting = list(_each(plan.expressions()))
    while waiting:
        expression = waiting.pop()
        yield expression
        waiting.extend(_each(expression.children()))


def _steps(plan: JavaObject) -> Iterator[JavaObject]:
    """All steps of a parsed query, those of subqueries and CTEs included."""
    waiting = [plan]
    while waiting:
        step = waiting.pop()
        yield step
        for inner in (step.children(), step.subqueries(), step.innerChildren()):
            waiting.extend(_each(inner))


def check_plan(spark: SparkSession, query: str, allowed: Collection[str]) -> None:
    """Refuse a query unless Spark's parse of it only reads allowed relations.

    The text rules of G2 miss relations after a comma and take CTE names for
    tables.  The parsed query shows both as they are.
    """
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(query)
    except Exception as error:
        raise RefusedQuery(f"not a query Spark can read: {error}") from error

    relations: set[str] = set()
    ctes: set[str] = set()
    for step in _steps(plan):
        kind = step.getClass().getSimpleName()
        if kind not in _READING_STEPS:
            raise RefusedQuery(f"not allowed in a query: {kind}")
        if kind == "UnresolvedRelation":
            parts = list(_each(step.multipartIdentifier()))
            relations.add(".".join(parts).lower())
        elif kind == "UnresolvedWith":
            ctes.update(cte._1().lower() for cte in _each(step.cteRelations()))
        for expression in _expressions(step):
            kind = expression.getClass().getSimpleName()
            if kind == "ExpressionWithUnresolvedIdentifier":
                raise RefusedQuery("names must be written out")
            if kind == "UnresolvedFunction":
                name = list(_each(expression.nameParts()))[-1].lower()
                if name in _CODE_CALLS:
                    raise RefusedQuery(f"function not allowed: {name}")

    if not relations - ctes:
        raise RefusedQuery(NO_VIEW)
    for name in ctes:
        # Which of the two a name means depends on where it stands.
        if name in allowed or spark.catalog.tableExists(name):
            raise RefusedQuery(f"CTE named like a table: {name}")
    others = relations - ctes - set(allowed)
    if others:
        raise RefusedQuery(f"{OTHER_RELATION}: {', '.join(sorted(others))}")


def guarded_sql(
    spark: SparkSession, text: str, allowed: Collection[str] = tuple(VIEWS)
) -> DataFrame:
    """Run one ad-hoc query over the allowed views, or refuse it.

    The views must be registered in the session (``create_views``).
    """
    probe = spark.range(1).select(normalized_query(F.lit(text)).alias("query"))
    query, reason = probe.select("query", _text_reason(F.col("query")).alias("reason")).first()
    if reason:
        raise RefusedQuery(reason)
    check_plan(spark, query, allowed)
    missing = [v for v in allowed if not spark.catalog.tableExists(v)]
    if missing:
        raise RefusedQuery(f"views not registered: {', '.join(missing)}")
    return spark.sql(query)


def result_preview(result: DataFrame, n: int = RESULT_PREVIEW_ROWS) -> DataFrame:
    """One row that sums a result up in a sentence.

    An action: counts the result and fetches its first ``n`` rows.  These are two
    runs on purpose: counting needs no order and no columns, and the first rows need
    not the rest; one run for both would keep the whole result.
    """
    # The sentences of the summary.
    rows = result.count()
    top = [_plain(row.asDict()) for row in result.head(n)]
    if not rows:
        text = "The query ran successfully but returned no rows."
    elif rows == 1 and len(result.columns) == 1:
        (name, value), *_ = top[0].items()
        text = f"{name}: {value}"
    else:
        text = f"Returned {rows:,} row(s). Top rows: {top}"
    return result.sparkSession.createDataFrame(
        [(rows, len(result.columns), text)], "row_count long, column_count int, summary string"
    )


def _plain(row: dict[str, Any]) -> dict[str, Any]:
    return {k: float(v) if isinstance(v, Decimal) else v for k, v in row.items()}


def bar_shape(result: DataFrame) -> DataFrame:
    """First column as label, second as value, smallest value first."""
    label, value = result.columns[:2]
    shaped = result.select(F.col(label).alias("label"), F.col(value).alias("value"))
    return shaped.orderBy(F.col("value").asc_nulls_last(), "label")


def pie_shape(result: DataFrame) -> DataFrame:
    """First column as text, second as a number; null where it is none."""
    label, value = result.columns[:2]
    return result.select(
        F.col(label).cast("string").alias("label"), F.col(value).try_cast("double").alias("value")
    )
