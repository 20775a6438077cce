"""Batch jobs from raw files to views (H1, H2, H3, H4).

A job writes before it reports, and reports from what it wrote: each expensive
step runs once, and a repeated task cannot change a number.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from lendscope.model import NA_TOKENS, PREVIEW_ROWS
from lendscope.operators import cleaning, conform, profiling, sinks, views
from lendscope.session import SCRATCH_OPTIONS, free_shuffles, scratch_path, sized_shuffles
from lendscope.sources import csv_files
from lendscope.sources.discover import discover, list_files, require

Candidates = Sequence[str | Sequence[str]]


def profile_job(
    spark: SparkSession,
    candidates: Candidates,
    preview_folder: str,
    preview_rows: int = PREVIEW_ROWS,
    line_breaks: str = "check",
) -> DataFrame:
    """H1: write a preview of each raw file and report its columns.

    Files of one header row are handled together.  Columns keep their raw names.
    """
    files = require(discover(spark, candidates), candidates)
    reports = []
    for layout in csv_files.layouts(spark, files, line_breaks):
        cells = [f"cell_{i}" for i in range(len(layout.headers))]
        raw = csv_files.scan(spark, layout, cells, position=True)
        sinks.save_preview(raw, preview_folder, preview_rows, layout.headers)
        texts = cleaning.null_out_tokens(raw, NA_TOKENS)
        reports.append(profiling.schema_report(texts, layout.headers))
    return csv_files.union_by_name(reports)


class CleanResult:
    """What a cleaning run wrote, and reports about it, each made when first asked for."""

    def __init__(self, path: str, cleaned: DataFrame, counted: DataFrame, exact_quartiles: bool):
        self.path, self.cleaned = path, cleaned
        self._counted, self._exact = counted, exact_quartiles

    @cached_property
    def summary(self) -> DataFrame:
        """D19."""
        return profiling.run_summary(self._counted, len(self.cleaned.columns))

    @cached_property
    def null_percentages(self) -> DataFrame:
        """D17."""
        return profiling.null_percentages(self.cleaned)

    @cached_property
    def numeric_stats(self) -> DataFrame:
        """D18; exact quartiles take two passes before this one."""
        return profiling.numeric_stats(self.cleaned, exact=self._exact)

    @cached_property
    def coercion_failures(self) -> DataFrame:
        """C5, C6."""
        return cleaning.coercion_report(self._counted, "copies")


def clean_job(
    spark: SparkSession,
    candidates: Candidates,
    output: str,
    line_breaks: str = "check",
    exact_quartiles: bool = True,
) -> CleanResult:
    """H2: read all raw files, clean them, write Parquet in place of old output, and report.

    The files are parsed once: the rows without duplicates, still as text and with
    how often each occurred, are stored in the shared folder; the clean data and the
    reports come from those.
    """
    files = require(discover(spark, candidates), candidates)
    raw = csv_files.read_raw(spark, files, line_breaks=line_breaks)
    stored = scratch_path(spark, "deduplicated")
    with sized_shuffles(spark, sum(f.length for f in files)):
        counts = cleaning.copy_counts(cleaning.tidy_text(raw))
        counts.write.options(**SCRATCH_OPTIONS).parquet(stored)
    free_shuffles(spark)
    counted = spark.read.parquet(stored)
    sinks.save_clean(cleaning.to_types(counted.drop("copies")), output)
    return CleanResult(output, sinks.read_clean(spark, output), counted, exact_quartiles)


@dataclass(frozen=True)
class LoadResult:
    """A loaded table, its chunks, and columns that did not match."""

    loans: DataFrame
    chunks: DataFrame
    columns: DataFrame


def _stored_bytes(spark: SparkSession, path: str) -> int:
    """Size of a stored dataset.  Parquet opens to several times its size."""
    return 4 * sum(f.length for f in list_files(spark, path, "*"))


def load_job(spark: SparkSession, clean_path: str, table: str, form: str = "parquet") -> LoadResult:
    """H3: replace the catalog table with the rows of a cleaned dataset."""
    cleaned = sinks.read_clean(spark, clean_path, form)
    with sized_shuffles(spark, _stored_bytes(spark, clean_path)):
        sinks.write_table(cleaned, table)
    loans = spark.table(table)
    return LoadResult(loans, sinks.load_report(loans), conform.conform_report(cleaned))


def load_files_job(
    spark: SparkSession, clean_path: str, table_path: str, form: str = "parquet"
) -> LoadResult:
    """H3 without a catalog: the table as files under a new path."""
    cleaned = sinks.read_clean(spark, clean_path, form)
    with sized_shuffles(spark, _stored_bytes(spark, clean_path)):
        sinks.write_table_files(cleaned, table_path)
    stored = spark.read.schema(sinks.TABLE_SCHEMA).parquet(table_path)
    return LoadResult(
        sinks.read_table_files(spark, table_path),
        sinks.load_report(stored),
        conform.conform_report(cleaned),
    )


def view_job(spark: SparkSession, table: str) -> dict[str, DataFrame]:
    """H4: register the views over a table that is there."""
    if not sinks.table_exists(spark, table):
        raise ValueError(f"no such table: {table}")
    return views.create_views(spark.table(table))
