"""Writing previews, clean data and the loans table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.model import (
    INSERT_BATCH_ROWS,
    LOAN_SCHEMA,
    POSITION,
    PREVIEW_ROWS,
    ROW_KEY,
    SOURCE_FILE,
)
from lendscope.operators.conform import conform
from lendscope.session import free_shuffles
from lendscope.sources import csv_files
from lendscope.sources.discover import list_files

YEAR, STATE, INDUSTRY = "approval_fiscal_year", "borrower_state", "naics_code"
TABLE_SCHEMA = T.StructType([T.StructField(ROW_KEY, T.LongType()), *LOAN_SCHEMA.fields])

#: Bits of a stored row key that count within the task that wrote the row.
KEY_BITS = 33
#: Runs of keys, of two numbers each, that are broadcast.
MOST_RUNS = 500_000

_WINDOW_LIMIT = "spark.sql.optimizer.windowGroupLimitThreshold"

#: Row groups of clean data: several tasks can read one file of it, as a chunk of one file needs.
CLEAN_GROUP_BYTES = 16 << 20
#: They lie beside the raw files they are made from, so they are kept small.
CLEAN_OPTIONS = {"parquet.block.size": CLEAN_GROUP_BYTES, "compression": "zstd"}

_CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "dateFormat": "yyyy-MM-dd",
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def first_rows(raw: DataFrame, n: int = PREVIEW_ROWS) -> DataFrame:
    """The first ``n`` rows of every file, in file order.

    ``raw`` comes from ``scan`` with positions.  Up to the number of rows for which Spark
    limits a window before its shuffle, each task sends its own first rows of a file.  For
    more, counting rows per piece of a file shows which leading pieces hold its first rows;
    only rows of those are shuffled and numbered, however large the file is.
    """
    path, block, row = POSITION
    place = F.row_number().over(Window.partitionBy(path).orderBy(block, row))
    if n <= int(raw.sparkSession.conf.get(_WINDOW_LIMIT, "1000")):
        numbered = raw.withColumn("place", place).where(F.col("place") <= n)
        return numbered.select(*raw.columns, "place")
    in_file = Window.partitionBy(path).orderBy(block)
    before = F.sum("count").over(in_file.rowsBetween(Window.unboundedPreceding, -1))
    leading = (
        raw.groupBy(path, block)
        .count()
        .withColumn("before", F.coalesce(before, F.lit(0)))
        .where(F.col("before") < n)
        .select(path, block)
    )
    return (
        raw.join(leading, [path, block], "left_semi")
        .withColumn("place", place)
        .where(F.col("place") <= n)
        .select(*raw.columns, "place")
    )


def distinct_names(headers: Sequence[str]) -> list[str]:
    """The headers, with numbers behind those that differ from an earlier one in case or not at all."""
    taken: set[str] = set()
    names = []
    for header in headers:
        name, number = header, 0
        while name.lower() in taken:
            number += 1
            name = f"{header}.{number}"
        taken.add(name.lower())
        names.append(name)
    return names


def preview_name(path: str) -> Column:
    """Name of a file's preview: the file's own without ending, and a mark of its full path."""
    stem = F.regexp_extract(F.url_decode(path), r"([^/]*?)(\.[^./]*)?$", 1)
    return F.concat_ws("-", stem, F.substring(F.md5(path), 1, 8))


def save_preview(
    raw: DataFrame, folder: str, n: int = PREVIEW_ROWS, headers: Sequence[str] | None = None
) -> DataFrame:
    """Write the first rows of every file to ``folder/preview=<name>``, as CSV.

    Previews of the same file are replaced, others stay.  ``headers`` are written in
    place of the columns' own names.  Returns the preview rows.
    """
    rows = first_rows(raw, n)
    columns = [c for c in raw.columns if c not in (SOURCE_FILE, *POSITION)]
    names = distinct_names(headers or columns)
    (
        rows.withColumn("preview", preview_name(POSITION[0]))
        .sortWithinPartitions("preview", POSITION[0], "place")
        .select(*[F.col(f"`{c}`").alias(n) for c, n in zip(columns, names, strict=True)], "preview")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("preview")
        .options(**_CSV)
        .csv(folder)
    )
    return rows


def save_clean(df: DataFrame, path: str, form: str = "parquet") -> str:
    """Write a cleaned dataset in place of an old one; dates are ISO text where the form
    has no dates."""
    writer = df.write.mode("overwrite")
    if form == "csv":
        writer.options(**_CSV).csv(path)
    else:
        writer.options(**(CLEAN_OPTIONS if form == "parquet" else {})).format(form).save(path)
    return path


def read_clean(spark: SparkSession, path: str, form: str = "parquet") -> DataFrame:
    """A cleaned dataset, read in the pieces Spark cuts files into.

    Text files come back as text; ``conform`` gives them their types.
    """
    if form != "csv":
        return spark.read.format(form).load(path)
    frames = []
    for layout in csv_files.layouts(spark, list_files(spark, path)):
        cells = [f"cell_{i}" for i in range(len(layout.headers))]
        scanned = csv_files.scan(spark, layout, cells)
        frames.append(scanned.select(*[F.col(c).alias(h) for c, h in zip(cells, layout.headers)]))
    return csv_files.union_by_name(frames)


Arrangement = Callable[[DataFrame], DataFrame]


def arrange(loans: DataFrame) -> DataFrame:
    """Rows laid out for the filters on year, state and industry.

    Rows of a year and state come together and are sorted, so a filter skips
    most row groups.  ``rebalance`` makes partitions of even size: it joins small
    groups and cuts a large one, also one that holds a third of all rows.
    """
    return loans.hint("rebalance", YEAR, STATE).sortWithinPartitions(YEAR, STATE, INDUSTRY)


def with_row_key(loans: DataFrame) -> DataFrame:
    """A unique row key from 1 up.  Keys have gaps, which ``with_contiguous_keys`` closes
    when they are read; no shuffle is needed."""
    key = (F.monotonically_increasing_id() + 1).alias(ROW_KEY)
    return loans.select(key, "*")


def with_contiguous_keys(table: DataFrame) -> DataFrame:
    """A14 without gaps: keys 1 to n in place of the stored ones, in their order.

    ``table`` is a whole loaded table, of one or more loads; filter what comes out.  Stored
    keys run on within each task that wrote, so counts per task and running totals of them
    say where each run begins; they are made per block of tasks and moved up by the blocks
    before.  Only keys are read for that, twice, and no row is shuffled up to ``MOST_RUNS``
    writing tasks, whose run begins are broadcast; beyond, rows meet them by a shuffle.
    """
    stored = F.col(ROW_KEY) - 1
    run = F.shiftright(stored, KEY_BITS)
    runs = table.groupBy(run.alias("run")).agg(F.count(F.lit(1)).alias("n"))
    runs = runs.withColumn("block", F.shiftright("run", 12))
    blocks = runs.groupBy("block").agg(F.sum("n").alias("block_rows"))
    moved = blocks.select(
        F.col("block"),
        (F.sum("block_rows").over(Window.orderBy("block")) - F.col("block_rows")).alias("earlier"),
    )
    within = F.sum("n").over(Window.partitionBy("block").orderBy("run")) - F.col("n")
    begins = (
        runs.withColumn("within", within)
        .join(moved, "block")
        .select("run", (F.col("earlier") + F.col("within")).alias("before"))
    )
    if runs.count() <= MOST_RUNS:
        begins = F.broadcast(begins)
    position = stored.bitwiseAND((1 << KEY_BITS) - 1)
    return (
        table.withColumn("run", run)
        .join(begins, "run")
        .withColumn(ROW_KEY, F.col("before") + position + 1)
        .select(*table.columns)
    )


def table_rows(cleaned: DataFrame, arranged: Arrangement = arrange) -> DataFrame:
    """Cleaned rows as the loans table stores them."""
    return with_row_key(arranged(conform(cleaned)))


def create_table(spark: SparkSession, name: str) -> None:
    """An empty loans table of the fixed schema, in place of any old one."""
    empty = spark.createDataFrame([], TABLE_SCHEMA)
    empty.write.mode("overwrite").partitionBy(YEAR).saveAsTable(name)


def write_table(
    cleaned: DataFrame, name: str, arranged: Arrangement = arrange, **options: str
) -> None:
    """Fill the catalog table in one distributed write, replacing its rows."""
    table_rows(cleaned, arranged).write.options(**options).mode("overwrite").partitionBy(YEAR).saveAsTable(name)
    free_shuffles(cleaned.sparkSession)


def write_table_files(
    cleaned: DataFrame, path: str, arranged: Arrangement = arrange, **options: str
) -> None:
    """A12 without a catalog: the table as Parquet files under a new path.

    Files appear when the job commits, so a reader never sees half a table.  ``arranged``
    lays the rows out: by year, state and industry, or ``layout.along_curve``.
    """
    table_rows(cleaned, arranged).write.options(**options).partitionBy(YEAR).parquet(path)
    free_shuffles(cleaned.sparkSession)


def write_database(
    cleaned: DataFrame, url: str, table: str, batch_rows: int = INSERT_BATCH_ROWS, **options: str
) -> None:
    """A12 into a database: each task inserts its rows in batches."""
    (
        conform(cleaned)
        .write.format("jdbc")
        .options(url=url, dbtable=table, batchsize=batch_rows, truncate=True, **options)
        .mode("overwrite")
        .save()
    )


def read_table_files(spark: SparkSession, path: str) -> DataFrame:
    """The loans table from its files.  The fixed schema saves a look at the files."""
    return spark.read.schema(TABLE_SCHEMA).parquet(path).select(*TABLE_SCHEMA.names)


def load_report(table: DataFrame) -> DataFrame:
    """Rows per loaded chunk, the running total, and the total.

    A chunk is a written file.  Running totals are made per year and then moved
    up by the totals of the years before, so no task sees the files of all years.
    """
    chunks = table.groupBy(YEAR, F.col("_metadata.file_name").alias("chunk")).agg(
        F.count(F.lit(1)).alias("chunk_rows")
    )
    running = Window.partitionBy(YEAR).orderBy("chunk")
    years = chunks.groupBy(YEAR).agg(F.sum("chunk_rows").alias("year_rows"))
    earlier = Window.orderBy(F.col(YEAR).asc_nulls_last())
    offsets = years.select(
        F.col(YEAR).alias("year"),
        (F.sum("year_rows").over(earlier) - F.col("year_rows")).alias("rows_before"),
        F.sum("year_rows").over(Window.partitionBy()).alias("total_rows"),
    )
    return (
        chunks.withColumn(
            "so_far",
            F.sum("chunk_rows").over(running.rowsBetween(Window.unboundedPreceding, 0)),
        )
        .join(offsets, F.col(YEAR).eqNullSafe(F.col("year")))
        .select(
            YEAR,
            "chunk",
            "chunk_rows",
            (F.col("rows_before") + F.col("so_far")).alias("rows_loaded"),
            "total_rows",
        )
    )


def table_exists(spark: SparkSession, name: str) -> bool:
    """The catalog knows this table or view."""
    return spark.catalog.tableExists(name)


def has_rows(df: DataFrame) -> bool:
    """There is at least one row."""
    return not df.isEmpty()
