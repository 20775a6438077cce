"""Orders and limits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.model import RESULT_PREVIEW_ROWS


def ranked(df: DataFrame, *measures: str, tie: str) -> DataFrame:
    """Largest first, unknown before all; ties by the group key.

    The tie-break makes every top-k a fixed set of rows.
    """
    keys = [F.col(m).desc_nulls_first() for m in measures]
    return df.orderBy(*keys, F.col(tie).asc_nulls_last())


def top(df: DataFrame, k: int, *measures: str, tie: str) -> DataFrame:
    """The first ``k`` of a ranking.

    Spark runs this as one top-k operator: each task keeps ``k`` rows.
    """
    return ranked(df, *measures, tie=tie).limit(k)


def options_order(df: DataFrame, *keys: str) -> DataFrame:
    """Smallest first, unknown last."""
    return df.orderBy(*[F.col(k).asc_nulls_last() for k in keys])


def chart_order(df: DataFrame, measure: str, tie: str) -> DataFrame:
    """E5: an already limited result re-sorted smallest first, for bar charts."""
    return df.orderBy(F.col(measure).asc_nulls_last(), F.col(tie).asc_nulls_last())


def first(df: DataFrame) -> DataFrame:
    """The leading row of a ranking."""
    return df.limit(1)


def head(df: DataFrame, n: int = RESULT_PREVIEW_ROWS) -> DataFrame:
    """The leading rows of a result."""
    return df.limit(n)
