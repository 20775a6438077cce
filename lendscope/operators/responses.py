"""Reading logged model responses.

All are projections over a table of responses, row by row, with JSON built-ins.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.functions.cells import strip

_BODY = (
    "output array<struct<type: string, content: array<struct<type: string, text: string>>>>"
)
_FIELDS = ("can_answer", "sql", "answer_title", "chart_type", "notes")
_PAYLOAD = f"array<struct<{', '.join(f'{name}: string' for name in _FIELDS)}>>"
_STRICT = {"allowSingleQuotes": "false"}

# What stands for a field that a payload leaves out.
UNSUPPORTED_TITLE = "Question not supported"
UNSUPPORTED_NOTES = "This question could not be answered from the allowed analytical views."
DEFAULT_TITLE = "Ask the Data"
DEFAULT_CHART = "table"


def response_text(body: Column) -> Column:
    """The texts of the messages in a response body, one per line."""
    messages = F.filter(
        F.from_json(body, _BODY, _STRICT)["output"], lambda item: item["type"] == "message"
    )
    parts = F.flatten(
        F.transform(messages, lambda item: F.coalesce(item["content"], F.array().cast(_CONTENT)))
    )
    texts = F.transform(
        F.filter(parts, lambda part: part["type"] == "output_text"), lambda part: part["text"]
    )
    filled = F.filter(texts, lambda text: text != "")
    return F.coalesce(strip(F.array_join(filled, "\n")), F.lit(""))


_CONTENT = "array<struct<type: string, text: string>>"


def without_fence(text: Column) -> Column:
    """The text without a Markdown code fence around it."""
    bare = strip(text)
    # The patterns of a fence's first and last line.
    opened = F.regexp_replace(bare, r"(?U)^```[a-zA-Z0-9_-]*\s*", "")
    inside = F.regexp_replace(opened, r"(?U)\s*```$", "")
    return strip(F.when(bare.startswith("```"), inside).otherwise(bare))


def payload(text: Column) -> Column:
    """The fields of a JSON object as text; null when it is not exactly one.

    Read inside brackets: anything after the object then makes it invalid.
    """
    listed = F.from_json(F.concat(F.lit("["), text, F.lit("]")), _PAYLOAD, _STRICT)
    return F.when(text.startswith("{") & (F.size(listed) == 1), listed[0])


def _is_true(value: Column) -> Column:
    """Whether a JSON value, given as text, counts as true."""
    empty = ("", "false", "0", "0.0", "[]", "{}")
    return F.coalesce(~value.isin(*empty), F.lit(False))


def answers(log: DataFrame, body: str = "body") -> DataFrame:
    """Each response with its text, status and completed fields.

    ``status`` is ``empty`` without text, ``bad json`` when the text is no JSON
    object, ``unsupported`` when the model could not answer, else ``answered``.
    Notes of an answer that has none are left null: they sum up its result.
    """
    answered = F.col("status") == "answered"
    unsupported = F.col("status") == "unsupported"
    field = {name: F.col("payload")[name] for name in _FIELDS}

    def choose(if_answered: Column, if_unsupported: Column) -> Column:
        return F.when(answered, if_answered).when(unsupported, if_unsupported)

    return (
        log.withColumn("text", response_text(F.col(body)))
        .withColumn("payload", payload(without_fence(F.col("text"))))
        .withColumn(
            "status",
            F.when(F.col("text") == "", "empty")
            .when(F.col("payload").isNull(), "bad json")
            .when(_is_true(field["can_answer"]), "answered")
            .otherwise("unsupported"),
        )
        .withColumn("sql", choose(F.coalesce(field["sql"], F.lit("")), F.lit("")))
        .withColumn(
            "answer_title",
            choose(
                F.coalesce(field["answer_title"], F.lit(DEFAULT_TITLE)),
                F.coalesce(field["answer_title"], F.lit(UNSUPPORTED_TITLE)),
            ),
        )
        .withColumn(
            "notes",
            choose(field["notes"], F.coalesce(field["notes"], F.lit(UNSUPPORTED_NOTES))),
        )
        .withColumn(
            "chart_type",
            choose(F.coalesce(field["chart_type"], F.lit(DEFAULT_CHART)), F.lit(DEFAULT_CHART)),
        )
        .drop("payload")
    )
