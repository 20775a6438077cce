"""Fitting rows to the loans table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.functions import cells
from lendscope.model import LOAN_COLUMNS, LOAN_TYPES, NA_TOKENS


def _as_column(df: DataFrame, name: str) -> Column:
    kind = LOAN_TYPES[name]
    if name not in df.columns:
        return F.lit(None).cast(kind).alias(name)
    cell = F.col(name)
    if isinstance(df.schema[name].dataType, T.StringType):
        return cells.to_type(cells.null_tokens(cell, NA_TOKENS), kind).alias(name)
    return cell.try_cast(kind).alias(name)


def prepare(df: DataFrame) -> DataFrame:
    """Coerce the known columns again, so text files load like typed ones.

    A second application changes nothing.
    """
    known = [c for c in df.columns if c in LOAN_TYPES]
    return df.withColumns({c: _as_column(df, c) for c in known})


def conform(df: DataFrame) -> DataFrame:
    """Exactly the table's columns, types and order; absent ones are null.

    Columns the table does not have are left out; ``conform_report`` names them.
    """
    return df.select(*[_as_column(df, c) for c in LOAN_COLUMNS])


def conform_report(df: DataFrame) -> DataFrame:
    """One row per column with ``matched``, ``absent`` or ``extra``.

    Made from column names alone; no data is read.
    """
    lines = [(c, "matched" if c in df.columns else "absent") for c in LOAN_COLUMNS]
    lines += [(c, "extra") for c in df.columns if c not in LOAN_TYPES]
    return df.sparkSession.createDataFrame(lines, "column_name string, status string")
