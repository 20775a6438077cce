"""Reading raw CSV files with differing headers.

Spark matches CSV columns by position, so files are grouped by their header row
and each group is read on its own; the groups are then joined by column name.

One grammar of rows holds for files of every size (``spanning``).  One pass over all
lines finds each file's header row, whether any of its rows spans lines, and whether
it has a CR that does not end a line, at which Spark's CSV reader would end one.  A
file without either is cut safely and read by that reader; any other is read as lines,
in pieces, and the lines of each row are joined.
"""

from __future__ import annotations

import csv
import io
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.functions import cells
from lendscope.model import CLEANING_NA_TOKENS, NA_TOKENS, POSITION, SOURCE_FILE
from lendscope.operators.cleaning import null_out_tokens
from lendscope.operators.naming import canonical_names
from lendscope.sources import spanning
from lendscope.sources.discover import SourceFile

# Ways of reading a file.
CUT, JOINED = "cut", "joined"
_RAW_ROW = "raw_row"
_OPTIONS = {
    "quote": '"',
    "escape": '"',
    "mode": "PERMISSIVE",
    "columnNameOfCorruptRecord": _RAW_ROW,
    "columnPruning": "false",
}


@dataclass(frozen=True)
class Layout:
    """Files that share a header row and a way of being read."""

    headers: tuple[str, ...]
    way: str
    paths: tuple[str, ...]


def header_cells(text: str) -> tuple[str, ...]:
    """The cells of a header row; one without a name is named by its position."""
    # Lines end at LF only; Python's reader would end one at a CR too.
    cr = next(c for c in map(chr, range(0xE000, 0x110000)) if c not in text)
    lines = io.StringIO(text.lstrip("\ufeff").replace("\r", cr), newline="\n")
    row = [cell.replace(cr, "\r") for cell in next(csv.reader(lines), [])]
    return tuple(cell or f"Unnamed: {i}" for i, cell in enumerate(row))


def _spanning_headers(spark: SparkSession, paths: Sequence[str]) -> dict[str, str]:
    """Header rows of files whose header spans lines, all in one job."""
    if not paths:
        return {}
    rows = spanning.records(spark, paths).where("header").select(POSITION[0], "record")
    return {r[0]: r[1] for r in rows.collect()}


def _same_file(path: str) -> str:
    """A spelling of a path that does not depend on how its scheme is written."""
    scheme, _, rest = path.partition(":")
    return f"{scheme}:/{rest.lstrip('/')}" if rest else path


def layouts(
    spark: SparkSession, files: Sequence[SourceFile], line_breaks: str = "check"
) -> list[Layout]:
    """The files grouped by header row and way of reading; files without a row are left out.

    ``line_breaks`` says whether cells may hold them: ``check`` looks; ``none``
    promises there are none; ``any`` takes it that there are.  A file with a CR inside
    a line is read as lines in any case.  One job reads all files, and one more those
    whose header row spans lines.
    """
    if line_breaks not in ("check", "none", "any"):
        raise ValueError(f"unknown line_breaks: {line_breaks}")
    found = {r[POSITION[0]]: r for r in spanning.survey(spark, [f.path for f in files]).collect()}
    # Positions spell a path as a URI.
    by_file = {_same_file(unquote(p)): (p, r) for p, r in found.items()}
    known = {f.path: by_file[_same_file(f.path)] for f in files if _same_file(f.path) in by_file}
    long_headers = _spanning_headers(spark, [f for f, (_, r) in known.items() if r.header_spans])
    grouped: dict[tuple, list[str]] = defaultdict(list)
    for file in files:
        path, row = known.get(file.path, (None, None))
        if row is None or row.header is None:
            continue
        spans = {"check": row.spans, "none": False, "any": True}[line_breaks] or row.lone_cr
        header = header_cells(long_headers.get(path, row.header))
        grouped[header, JOINED if spans else CUT].append(file.path)
    return [Layout(header, way, tuple(paths)) for (header, way), paths in grouped.items()]


def scan(
    spark: SparkSession, layout: Layout, names: Sequence[str], *, position: bool = False
) -> DataFrame:
    """All cells of one layout as text, with the name of the file each row is from (A5).

    A row with more cells than the header has fails the job, whatever they hold; a
    shorter row is filled up with nulls.  ``position`` adds the file path, where in
    the file the piece starts, and a number that grows with the rows of a piece.
    """
    fields = [f"cell_{i}" for i in range(len(layout.headers))]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*fields, _RAW_ROW]])
    if layout.way == JOINED:
        records = spanning.records(spark, layout.paths).where("not header")
        cells_of = F.from_csv("record", F.lit(schema.toDDL()), _OPTIONS)
        # A generator, since a condition on cells is not moved below it: that parsed rows twice.
        rows = records.select(SOURCE_FILE, *POSITION, F.inline(F.array(cells_of)))
    else:
        rows = (
            spark.read.schema(schema)
            .options(header=True, enforceSchema=True, **_OPTIONS)
            .csv(list(layout.paths))
            .select(
                F.col("_metadata.file_name").alias(SOURCE_FILE),
                F.col("_metadata.file_path").alias(POSITION[0]),
                F.col("_metadata.file_block_start").alias(POSITION[1]),
                F.monotonically_increasing_id().alias(POSITION[2]),
                *schema.names,
            )
        )
    # The reader keeps the text of rows whose number of cells is not the header's.  The
    # length is only there because Spark does not read that text alone.
    surplus = F.concat(F.lit("row with more cells than its header in "), POSITION[0])
    odd = F.col(_RAW_ROW).isNotNull() & (F.coalesce(F.length(fields[0]), F.lit(0)) >= 0)
    fits = F.when(
        odd & (spanning.cell_count(F.col(_RAW_ROW)) > len(fields)),
        F.raise_error(surplus).cast("boolean"),
    ).otherwise(True)
    kept = [F.col(c).alias(n) for c, n in zip(fields, names) if n != SOURCE_FILE]
    kept += [SOURCE_FILE, *(POSITION if position else ())]
    return rows.where(fits).select(*kept)


def union_by_name(frames: Sequence[DataFrame]) -> DataFrame:
    """all rows; a column that a frame lacks is null for its rows."""
    if not frames:
        raise ValueError("no input files were loaded")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def read_raw(
    spark: SparkSession,
    files: Sequence[SourceFile],
    tokens: Sequence[str] = CLEANING_NA_TOKENS,
    line_breaks: str = "check",
    known: Sequence[Layout] | None = None,
) -> DataFrame:
    """Every cell as text under its table column name, NA tokens as null.

    Headers get their table names per file group, before the union: two
    spellings of one header then meet in one column.  ``known`` takes the files' layouts
    where they were asked for already, which saves the pass over all lines that finds them.
    """
    frames = [
        scan(spark, layout, canonical_names(layout.headers))
        for layout in (layouts(spark, files, line_breaks) if known is None else known)
    ]
    return union_by_name([null_out_tokens(frame, tokens) for frame in frames])


_DIGITS = r"^\s*[-+]?\d+\s*$"
_NUMBER = r"(?i)^\s*[-+]?(\d+\.?\d*(e[-+]?\d+)?|\.\d+(e[-+]?\d+)?|inf|infinity)\s*$"


def kind_code(cell: Column) -> Column:
    """A3: 1 for a whole number of 64 bits, 2 for another number, 3 for other text.

    The form of the text is tested before the cast: a cast that fails is slow,
    and one to double would take ``5D`` for a number.
    """
    whole = F.when(cell.rlike(_DIGITS), cell.try_cast("bigint")).isNotNull()
    return F.when(whole, 1).when(cell.rlike(_NUMBER), 2).when(cell.isNotNull(), 3)


def kind_of(cell: Column) -> Column:
    """A3: the narrowest type that all values of a column have, as an aggregate.

    A column without any value is a double.
    """
    widest = F.max(kind_code(cell))
    return (
        F.when(widest == 1, F.lit("bigint"))
        .when(widest == 3, F.lit("string"))
        .otherwise(F.lit("double"))
    )


def read_typed(
    spark: SparkSession, files: Sequence[SourceFile], line_breaks: str = "check"
) -> DataFrame:
    """A3: the files as one frame, each column of the narrowest type that all fit.

    One pass counts, for all columns at once, the values that fit each type.
    """
    raw = read_raw(spark, files, NA_TOKENS, line_breaks)
    texts = [c for c in raw.columns if c != SOURCE_FILE]
    kinds = raw.agg(*[kind_of(F.col(c)).alias(c) for c in texts]).first()
    return raw.select(*[F.col(c).try_cast(kinds[c]).alias(c) for c in texts], SOURCE_FILE)
