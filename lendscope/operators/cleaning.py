"""Cleaning steps on rows of text.

Every step skips columns that are absent, so files with different columns go
through the same code.  Steps are projections except the duplicate removal,
which is the only shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.functions import cells
from lendscope.model import (
    DATE_COLUMNS,
    DECIMAL_COLUMNS,
    INTEGER_COLUMNS,
    LENDER_SOURCES,
    LOAN_TYPES,
    POSITION,
    SOURCE_FILE,
)

_PACKED = "packed_cells_"
NUMERIC_COLUMNS = [c for c in LOAN_TYPES if c in {*DECIMAL_COLUMNS, *INTEGER_COLUMNS}]


def text_columns(df: DataFrame) -> list[str]:
    """Names of the text columns."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]


def null_out_tokens(df: DataFrame, tokens: Sequence[str]) -> DataFrame:
    """A4: null for every text cell that is exactly one of ``tokens``.

    What says where a row is from is no cell, and stays.
    """
    found = [c for c in text_columns(df) if c not in (SOURCE_FILE, *POSITION)]
    return df.withColumns({c: cells.null_tokens(F.col(c), tokens) for c in found})


def trim_text(df: DataFrame) -> DataFrame:
    """Strip white space from both ends of every text cell."""
    return df.withColumns({c: cells.strip(F.col(c)) for c in text_columns(df)})


def blank_to_null(df: DataFrame) -> DataFrame:
    """Null for every text cell that is empty or only white space."""
    return df.withColumns({c: cells.blank_to_null(F.col(c)) for c in text_columns(df)})


def empty_to_null(df: DataFrame) -> DataFrame:
    """B4 for text that is stripped already, where only the empty text is blank."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text_columns(df)})


def unify_lender(df: DataFrame) -> DataFrame:
    """One lender: the bank, else the third party, else the development company."""
    present = [c for c in LENDER_SOURCES if c in df.columns]
    return df.withColumn("lender_name", F.coalesce(*present)) if present else df


def drop_duplicates(df: DataFrame) -> DataFrame:
    """one of each set of fully equal rows; nulls count as equal.

    Copies collapse inside each task before the shuffle, so a row copied a
    billion times sends one row per task.
    """
    return df.dropDuplicates()


def copy_counts(df: DataFrame, name: str = "copies") -> DataFrame:
    """F2 that keeps how often each row occurred.

    The text cells of a row go through the shuffle as one text: a place and a length for each
    of many short cells take more room there than the cells do.
    """
    texts = text_columns(df)
    if len(texts) < 2 or len(set(df.columns)) < len(df.columns):
        return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias(name))
    others = [F.col(f"`{c}`") for c in df.columns if c not in texts]
    counted = (
        df.select(cells.packed([F.col(f"`{c}`") for c in texts]).alias(_PACKED), *others)
        .groupBy(_PACKED, *others)
        .agg(F.count(F.lit(1)).alias(name))
    )
    # Kept as a column, so that a row is taken apart once and not for each cell.
    counted = counted.withColumn(_PACKED, cells.parts(F.col(_PACKED)))
    opened = dict(zip(texts, cells.unpacked(F.col(_PACKED), len(texts)), strict=True))
    return counted.select(*[opened.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns], name)


def duplicate_count(df: DataFrame) -> DataFrame:
    """One row with the number of rows that F2 would remove."""
    extra = F.sum(F.col("copies") - 1)
    return copy_counts(df).agg(F.coalesce(extra, F.lit(0)).alias("duplicate_rows"))


def coerce_numbers(df: DataFrame) -> DataFrame:
    """Text in the number columns to decimals and whole numbers."""
    return _coerce(df, NUMERIC_COLUMNS)


def coerce_dates(df: DataFrame) -> DataFrame:
    """Text in the date columns to dates."""
    return _coerce(df, DATE_COLUMNS)


def _coerce(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    texts = set(text_columns(df))
    found = [c for c in columns if c in texts]
    return df.withColumns({c: cells.to_type(F.col(c), LOAN_TYPES[c]) for c in found})


def coercion_report(df: DataFrame, copies: str | None = None) -> DataFrame:
    """Per number or date column still held as text, how many cells do not
    convert, and how many of those hold a currency, thousands or percent sign.

    One pass and one row per task, whatever the number of columns.  ``copies`` names
    a column that says how many rows a row stands for.
    """
    texts = set(text_columns(df))
    found = [c for c in [*NUMERIC_COLUMNS, *DATE_COLUMNS] if c in texts]

    def rows_where(condition: Column) -> Column:
        if copies is None:
            return F.count_if(condition)
        return F.coalesce(F.sum(F.when(condition, F.col(copies))), F.lit(0))

    def line(name: str) -> Column:
        cell = F.col(name)
        failed = cells.coercion_failed(cell, cells.to_type(cell, LOAN_TYPES[name]))
        return F.struct(
            F.lit(name).alias("column_name"),
            rows_where(failed).alias("failed_values"),
            rows_where(failed & cells.has_symbols(cell)).alias("failed_with_symbols"),
        )

    return df.agg(F.array(*[line(c) for c in found]).alias("lines")).select(F.inline("lines"))


def tidy_text(raw: DataFrame) -> DataFrame:
    """The steps of cleaning before duplicates go: trimmed text, nulls, one lender."""
    return raw.transform(trim_text).transform(empty_to_null).transform(unify_lender)


def to_types(texts: DataFrame) -> DataFrame:
    """The steps of cleaning after duplicates are gone: numbers and dates."""
    return texts.transform(coerce_numbers).transform(coerce_dates)


def clean(raw: DataFrame) -> DataFrame:
    """The whole chain, in the order that decides the result (H2 without its ends).

    Duplicates go before coercion, so ``1,000`` and ``1000`` are different rows.
    """
    return raw.transform(tidy_text).transform(drop_duplicates).transform(to_types)
