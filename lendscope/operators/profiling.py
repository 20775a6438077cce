"""Profiles of whole tables.

A profile of many columns is one pass with one row of counters per task, spread
into one line per column at the end.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.model import POSITION, SOURCE_FILE
from lendscope.operators import selection
from lendscope.sources.csv_files import kind_of

QUARTILES = (0.25, 0.5, 0.75)


def _lines(
    df: DataFrame, columns: Sequence[str], line: Callable[[str], Column], *keys: str
) -> DataFrame:
    """One aggregate with a struct per column, as one row per column (and key)."""
    together = F.array(*[line(c) for c in columns]).alias("lines")
    return df.groupBy(*keys).agg(together).select(*keys, F.inline("lines"))


def _missing(column: str) -> Column:
    return F.count(F.lit(1)) - F.count(column)


def row_count(df: DataFrame) -> DataFrame:
    """A10: one row with the number of rows."""
    return df.agg(F.count(F.lit(1)).alias("row_count"))


def column_profile(df: DataFrame) -> DataFrame:
    """Name, type and number of missing values of each column."""

    def line(name: str) -> Column:
        return F.struct(
            F.lit(name).alias("column_name"),
            F.lit(df.schema[name].dataType.simpleString()).alias("dtype"),
            _missing(name).alias("missing_values"),
        )

    return _lines(df, df.columns, line)


def schema_report(raw: DataFrame, headers: Sequence[str] | None = None) -> DataFrame:
    """Per file and column of raw text, the type it would get and what is missing.

    ``raw`` comes from ``scan`` with positions.  ``headers`` are the names to report,
    whatever they hold and however often; without them the columns' own names are.
    All files of a header row are profiled in one pass; the types are found in the
    same pass.
    """
    columns = [c for c in raw.columns if c not in (SOURCE_FILE, *POSITION)]
    shown = dict(zip(columns, headers or columns, strict=True))

    def line(position: int, name: str) -> Column:
        return F.struct(
            F.count(F.lit(1)).alias("row_count"),
            F.lit(len(columns)).alias("column_count"),
            F.lit(position).alias("column_position"),
            F.lit(shown[name]).alias("column_name"),
            kind_of(F.col(f"`{name}`")).alias("dtype"),
            _missing(f"`{name}`").alias("missing_values"),
        )

    places = {name: i for i, name in enumerate(columns)}
    return _lines(raw, columns, lambda name: line(places[name], name), POSITION[0], SOURCE_FILE)


def null_percentages(df: DataFrame) -> DataFrame:
    """Share of missing values per column in percent, largest first."""

    def line(name: str) -> Column:
        rows = F.count(F.lit(1))
        share = F.try_divide(100.0 * (rows - F.count(name)), rows)
        return F.struct(
            F.lit(name).alias("column_name"), F.bround(share, 2).alias("null_percentage")
        )

    return _lines(df, df.columns, line).orderBy(
        F.col("null_percentage").desc_nulls_last(), "column_name"
    )


def numeric_columns(df: DataFrame) -> list[str]:
    """Names of the number columns."""
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def numeric_stats(
    df: DataFrame, columns: Sequence[str] | None = None, exact: bool = True
) -> DataFrame:
    """Count, mean, deviation, minimum, quartiles and maximum per number column.

    Quartiles interpolate between neighbours.  ``exact=False`` takes Spark's
    approximate percentiles instead, in the same single pass as the rest.
    """
    columns = numeric_columns(df) if columns is None else list(columns)
    parts = [f"p{round(q * 100)}" for q in QUARTILES]

    def line(name: str) -> Column:
        value = F.col(name).cast("double")
        # Whole numbers and decimals are added exactly, so no order of rows shows.
        added = F.col(name)
        if isinstance(df.schema[name].dataType, T.IntegralType):
            added = added.cast("decimal(20,0)")
        mean = F.try_divide(F.sum(added).cast("double"), F.count(name))
        fields = [
            F.lit(name).alias("column_name"),
            F.count(name).alias("count"),
            F.bround(mean, 2).alias("mean"),
            F.bround(F.stddev_samp(value), 2).alias("std"),
            F.bround(F.min(value), 2).alias("min"),
            F.bround(F.max(value), 2).alias("max"),
        ]
        if not exact:
            near = F.percentile_approx(value, list(QUARTILES), 10_000)
            fields += [F.bround(near[i], 2).alias(p) for i, p in enumerate(parts)]
        return F.struct(*fields)

    stats = _lines(df, columns, line)
    if exact:
        # Six places first: that takes off the noise of interpolating in binary.
        rounded = {p: F.bround(F.bround(p, 6), 2) for p in parts}
        stats = stats.join(
            quantiles(df, columns, QUARTILES).withColumns(rounded), "column_name", "left"
        )
    return stats.select("column_name", "count", "mean", "std", "min", *parts, "max")


def quantiles(
    df: DataFrame,
    columns: Sequence[str],
    fractions: Sequence[float],
    most: int = selection.MOST_LEFT,
) -> DataFrame:
    """Exact quantiles of many columns, one row per column that has values.

    Spark's exact percentile brings all distinct values of a column into one task.
    Here the two values around each wanted rank are selected by rounds; ``most`` rows of
    a column at most are ordered by one task.
    """
    spark = df.sparkSession
    parts = "".join(f", p{round(f * 100)} double" for f in fractions)
    schema = f"column_name string{parts}"
    if not columns or not fractions:
        return spark.createDataFrame([], schema)
    values = df.select(*[F.col(c).cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    sizes = list(values.agg(*[F.count(c) for c in values.columns]).head())
    places = {
        (i, f): f * (size - 1) for i, size in enumerate(sizes) if size for f in map(float, fractions)
    }
    wanted = {(i, ranks) for (i, _), p in places.items() for ranks in (math.floor(p), math.ceil(p))}
    found = selection.values_at(values, sizes, wanted, most)

    def value(i: int, f: float) -> float:
        place = places[i, f]
        low, high = found[i, math.floor(place)], found[i, math.ceil(place)]
        return low if low == high else low + (high - low) * (place - math.floor(place))

    # A row per column.
    rows = [
        (c, *[value(i, float(f)) for f in fractions]) for i, c in enumerate(columns) if sizes[i]
    ]
    return spark.createDataFrame(rows, schema)


def run_summary(counted: DataFrame, column_count: int) -> DataFrame:
    """One row with rows, columns and duplicates removed by a cleaning run.

    ``counted`` are the stored rows without duplicates, with how often each occurred
    in ``copies``: not counters inside the run, which count again when a task is
    repeated.
    """
    rows = F.count(F.lit(1))
    return counted.agg(
        rows.alias("row_count"),
        F.lit(column_count).alias("column_count"),
        (F.coalesce(F.sum("copies"), F.lit(0)) - rows).alias("duplicate_rows_removed"),
    )
