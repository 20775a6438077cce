"""The analytical views."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.operators import measures

# The views ad-hoc queries may use.
VIEWS: dict[str, Callable[[DataFrame], DataFrame]] = {
    "vw_state_funding": measures.state_view,
    "vw_industry_funding": measures.industry_view,
    "vw_loan_status_summary": measures.status_view,
    "vw_jobs_per_dollar": measures.jobs_per_dollar_view,
}


def create_views(loans: DataFrame) -> dict[str, DataFrame]:
    """Register the views over the loans table; each is computed when asked."""
    frames = {name: view(loans) for name, view in VIEWS.items()}
    for name, frame in frames.items():
        frame.createOrReplaceTempView(name)
    return frames


def view_columns(loans: DataFrame) -> DataFrame:
    """G1: the columns of each view, from their schemas."""
    lines = [
        (name, position, field.name, field.dataType.simpleString())
        for name, view in VIEWS.items()
        for position, field in enumerate(view(loans).schema)
    ]
    return loans.sparkSession.createDataFrame(
        lines, "view_name string, position int, column_name string, dtype string"
    ).orderBy(F.col("view_name"), F.col("position"))
