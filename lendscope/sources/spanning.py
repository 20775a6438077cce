"""Rows that span lines, in files read piece by piece.

One grammar holds for files of every size: lines end at LF, CRs before it go with it
and any other CR is text; a quote opens a cell only where the cell begins, two quotes
inside it stand for one, and any other quote is text.  Whether a
line begins inside a cell depends on all lines before it in its file, but what a
line does to that does not: started outside or inside a cell, it ends outside or
inside one.  So each piece is read once under both starts; how the pieces before
end then says how each begins, and which of its lines are parts of rows that cross
from one piece to the next.  Only those lines are shuffled; a second pass joins the
others within pieces.

A file whose last cell is never closed is an error, raised before any row is joined.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import TYPE_CHECKING

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lendscope.model import POSITION, SOURCE_FILE
from lendscope.session import scratch_path, share_package

if TYPE_CHECKING:
    import pyarrow as pa

PATH, BLOCK, ROW = POSITION
#: More pieces that begin a file or hold parts of rows are joined by a shuffle instead of a broadcast.
MOST_BROADCAST = 50_000
_RECORDS = (
    f"{SOURCE_FILE} string, {PATH} string, {BLOCK} long, {ROW} long, header boolean, record string"
)
_RECORD_NAMES = [SOURCE_FILE, PATH, BLOCK, ROW, "header", "record"]
_STATES = (
    f"{PATH} string, {BLOCK} long, from_outside boolean, from_inside boolean, head long, "
    "tail_outside long, tail_inside long, header long"
)
_PIECES = f"{PATH} string, {BLOCK} long, head long, tail long, header long"
#: Beyond the number of any line.
_NEVER = (1 << 63) - 1

_QUOTED = '"(?:[^"]++|"")*+'
_CELL = f'(?:{_QUOTED}"[^,]*+|[^",][^,]*+|)'
_OPENS = f"^(?:{_CELL},)*+{_QUOTED}$"
_STAYS = f'^(?:[^"]++|"")*+(?:$|"[^,]*+,(?:{_CELL},)*+{_QUOTED}$)'


def cell_count(record: Column) -> Column:
    """How many cells a row has."""
    return F.regexp_count(F.concat(F.lit(","), record), F.lit(f",{_CELL}"))


def _without_marks(line: Column) -> Column:
    """A line without CRs at its end and byte order marks at its start.

    Trimming walks the whole text, so it is left to lines that need it.
    """
    ended = F.when(F.endswith(line, F.lit("\r")), F.rtrim(line, F.lit("\r"))).otherwise(line)
    marked = F.startswith(line, F.lit("\ufeff"))
    return F.when(marked, F.ltrim(ended, F.lit("\ufeff"))).otherwise(ended)


def _text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All lines with their place."""
    return (
        spark.read.option("lineSep", "\n")
        .text(list(paths))
        .select(
            _without_marks(F.col("value")).alias("value"),
            F.col("_metadata.file_name").alias(SOURCE_FILE),
            F.col("_metadata.file_path").alias(PATH),
            F.col("_metadata.file_block_start").alias(BLOCK),
            F.monotonically_increasing_id().alias(ROW),
        )
    )


def lines_of(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All lines with their place, and whether they end inside a cell if started outside or
    inside one."""
    quoted = F.contains("value", F.lit('"'))
    return _text_lines(spark, paths).withColumns(
        {
            "opens": quoted & F.col("value").rlike(_OPENS),
            "stays": ~quoted | F.col("value").rlike(_STAYS),
        }
    )


def survey(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """One row a file: whether a cell may span lines, whether a CR is anywhere but at the end
    of a line, and the first line that is not blank.

    Where no line that starts outside a cell ends inside one, no row spans lines.
    """
    named = (F.col(BLOCK) == 0) & F.col("value").rlike(r"[^\x00-\x20]")
    first = F.min(F.when(named, F.struct(ROW, "value", "opens")))
    return (
        lines_of(spark, paths)
        .groupBy(PATH)
        .agg(
            F.bool_or("opens").alias("spans"),
            F.bool_or(F.contains("value", F.lit("\r"))).alias("lone_cr"),
            first.alias("first"),
        )
        .select(
            PATH, "spans", "lone_cr", F.col("first.value").alias("header"),
            F.col("first.opens").alias("header_spans"),
        )
    )


def _piece_states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How each piece ends for both ways it can begin, and which of its lines are then parts of
    rows of other pieces; lines come in order."""
    import numpy as np
    import pyarrow as pa

    place, found = None, _Piece()

    def row() -> dict:
        outside, inside = found.states
        return {
            PATH: place[0], BLOCK: place[1], "from_outside": outside, "from_inside": inside,
            "head": found.head, "tail_outside": found.begun[0] if outside else None,
            "tail_inside": found.begun[1] if inside else None, "header": found.header,
        }

    for batch in batches:
        if not batch.num_rows:
            continue
        done = []
        paths, blocks, numbers = batch.column(0), batch.column(1).to_numpy(), batch.column(2).to_numpy()
        flags = [batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 4, 5)]
        changed = blocks[1:] != blocks[:-1]
        if not paths.slice(1).equals(paths.slice(0, len(paths) - 1)):
            names = paths.to_numpy(zero_copy_only=False)
            changed = changed | (names[1:] != names[:-1])
        cuts = [0, *(np.flatnonzero(changed) + 1).tolist(), len(blocks)]
        for a, b in zip(cuts, cuts[1:]):
            key = (paths[a].as_py(), int(blocks[a]))
            if key != place:
                if place:
                    done.append(row())
                place, found = key, _Piece()
            found.add(numbers[a:b], *(flag[a:b] for flag in flags), first=key[1] == 0)
        if done:
            yield pa.RecordBatch.from_pylist(done, _piece_schema())
    if place:
        yield pa.RecordBatch.from_pylist([row()], _piece_schema())


class _Piece:
    """What the lines of a piece do, started outside a cell and inside one."""

    def __init__(self) -> None:
        self.states = (False, True)
        #: Where the row begins that the last line is of; none if it began in an earlier piece.
        self.begun: tuple[int | None, int | None] = (None, None)
        #: Last line of a row that began in an earlier piece.
        self.head = _NEVER
        #: First line that is not blank, in the first piece of a file.
        self.header: int | None = None

    def add(self, numbers, opens, stays, blank, first: bool) -> None:
        import numpy as np

        if first and self.header is None and not blank.all():
            self.header = int(numbers[np.argmin(blank)])
        states, begun = [], []
        for way, start in enumerate(self.states):
            if not way or start != self.states[0]:  # else both ways go on alike
                ends = _ends(opens, stays, start)
            if way and self.head == _NEVER and not ends.all():
                self.head = int(numbers[np.argmin(ends)])
            starts = np.flatnonzero(~np.concatenate([[start], ends[:-1]]))
            states.append(bool(ends[-1]))
            begun.append(int(numbers[starts[-1]]) if len(starts) else self.begun[way])
        self.states, self.begun = tuple(states), tuple(begun)


def _piece_schema() -> pa.Schema:
    import pyarrow as pa

    long, boolean = pa.int64(), pa.bool_()
    return pa.schema(
        [(PATH, pa.string()), (BLOCK, long), ("from_outside", boolean), ("from_inside", boolean),
         ("head", long), ("tail_outside", long), ("tail_inside", long), ("header", long)]
    )


def _ends(opens, stays, start: bool):
    """State after each line: a line sets it, flips it or leaves it."""
    import numpy as np

    place = np.arange(len(opens))
    last_set = np.maximum.accumulate(np.where(opens == stays, place, -1))
    flips = np.cumsum(opens & ~stays)
    base = np.where(last_set >= 0, opens[last_set], start)
    since = flips - np.where(last_set >= 0, flips[last_set], 0)
    return base ^ (since % 2 == 1)


def pieces(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The pieces with lines of rows of other pieces, and the first pieces of files; an error for
    a cell never closed.

    Up to ``head`` lines are of a row that began in an earlier piece, from ``tail`` on of one
    that ends in a later piece; ``header`` is the line where the header row begins.
    """
    lines = lines_of(spark, paths).select(
        PATH, BLOCK, ROW, "opens", "stays", _blank(F.col("value")).alias("blank")
    )
    states = lines.mapInArrow(_piece_states, _STATES)
    # As for lines: a piece sets the state, flips it or leaves it.
    sets = F.col("from_outside") == F.col("from_inside")
    flips = F.col("from_outside") & ~F.col("from_inside")
    through = Window.partitionBy(PATH).orderBy(BLOCK)
    counted = states.withColumn("flips", F.sum(flips.cast("int")).over(through))
    last = F.last(F.when(sets, F.struct("from_outside", "flips")), ignorenulls=True).over(through)
    ended = counted.withColumn("last", last).withColumn(
        "inside",
        F.coalesce(F.col("last.from_outside"), F.lit(False))
        != ((F.col("flips") - F.coalesce(F.col("last.flips"), F.lit(0))) % 2 == 1),
    )
    unclosed = F.raise_error(F.concat(F.lit("a quoted cell is never closed in "), PATH))
    begins = F.coalesce(F.lag("inside").over(through), F.lit(False))
    tail = F.when(F.col("begins"), F.col("tail_inside")).otherwise(F.col("tail_outside"))
    return (
        ended.withColumns({"begins": begins, "next": F.lead(BLOCK).over(through)})
        .where("begins or inside or header is not null")
        .select(
            PATH,
            BLOCK,
            F.when(F.col("begins"), F.col("head")).alias("head"),
            F.when(F.col("inside") & F.col("next").isNull(), unclosed.cast("long"))
            .when(F.col("inside"), tail)
            .alias("tail"),
            "header",
        )
    )


def _blank(text: Column) -> Column:
    return ~text.rlike(r"[^\x00-\x20]")


def records(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All rows of the files as text, with their positions; ``header`` marks header rows.

    Lines of rows that cross pieces are known by number, so the others are read once and
    joined in the order they are read; only those few lines are shuffled.
    """
    share_package(spark)
    found = pieces(spark, paths)
    few = found.limit(MOST_BROADCAST + 1).collect()
    if len(few) <= MOST_BROADCAST:
        known = F.broadcast(spark.createDataFrame(few, _PIECES))
    else:
        stored = scratch_path(spark, "pieces")
        found.write.parquet(stored)
        known = spark.read.schema(_PIECES).parquet(stored)

    crosses = F.coalesce(F.col(ROW) <= F.col("head"), F.lit(False)) | F.coalesce(
        F.col(ROW) >= F.col("tail"), F.lit(False)
    )
    is_header = F.coalesce(F.col(ROW) == F.col("header"), F.lit(False)).alias("header")
    marked = lines_of(spark, paths).join(known, [PATH, BLOCK], "left").where(~crosses)
    if len(few) > MOST_BROADCAST:
        marked = marked.sortWithinPartitions(PATH, BLOCK, ROW)
    joined = marked.select(
        SOURCE_FILE, PATH, BLOCK, ROW, is_header,
        F.concat("value", F.lit("\n")).alias("value"), "opens", "stays",
    ).mapInArrow(_joined, _RECORDS)
    whole = joined.where(~_blank(F.col("record"))).withColumn(
        "record", F.left("record", F.length("record") - 1)
    )

    crossing = known.where("head is not null or tail is not null")
    in_file = Window.partitionBy(PATH).orderBy(BLOCK, ROW)
    begins = F.coalesce(F.col(ROW) == F.col("tail"), F.lit(False))
    parts = F.array_sort(F.collect_list(F.struct(BLOCK, ROW, "header", "value")))
    put_together = (
        _text_lines(spark, paths)
        .join(crossing, [PATH, BLOCK])
        .where(crosses)
        .select(
            SOURCE_FILE, PATH, BLOCK, ROW, is_header, "value",
            F.sum(begins.cast("int")).over(in_file).alias("number"),
        )
        .groupBy(SOURCE_FILE, PATH, "number")
        .agg(parts.alias("parts"))
        .select(
            SOURCE_FILE,
            PATH,
            F.col("parts")[0][BLOCK].alias(BLOCK),
            F.col("parts")[0][ROW].alias(ROW),
            F.col("parts")[0]["header"].alias("header"),
            F.array_join(F.transform("parts", lambda part: part["value"]), "\n").alias("record"),
        )
    )
    return whole.unionByName(put_together)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines with their LF joined to rows, in the order they are read.

    Lines of rows that cross pieces are not among them, so every piece begins and ends outside
    a cell.  A row of lines that stand side by side in memory is one longer text there.
    """
    import numpy as np
    import pyarrow as pa

    begun = None  # where the row that is not complete is from
    pending: list[bytes] = []  # its lines
    for batch in batches:
        if not batch.num_rows:
            continue
        kept, value = batch.columns[:5], batch.column(5)
        opens, stays = (batch.column(i).to_numpy(zero_copy_only=False) for i in (6, 7))
        ends = _ends(opens, stays, bool(pending))
        first = np.flatnonzero(~np.concatenate([[bool(pending)], ends[:-1]]))
        width = np.int64 if pa.types.is_large_string(value.type) else np.int32
        offsets = np.frombuffer(value.buffers()[1], width)[value.offset :][: len(value) + 1]
        text = value.buffers()[2]
        bounds = np.append(offsets[first], offsets[-1])

        def record(start: int, stop: int) -> bytes:
            return text.slice(int(start), int(stop - start)).to_pybytes()

        if pending:
            pending.append(record(offsets[0], bounds[0]))
            if len(first) or not ends[-1]:
                joined = pa.array([b"".join(pending)], pa.binary()).view(pa.string())
                yield pa.RecordBatch.from_arrays([*begun, joined.cast(value.type)], _RECORD_NAMES)
                begun, pending = None, []
        if len(first) and ends[-1]:
            begun = [column.take(pa.array(first[-1:])) for column in kept]
            pending = [record(bounds[-2], bounds[-1])]
            first, bounds = first[:-1], bounds[:-1]
        if len(first):
            buffers = [None, pa.py_buffer(np.ascontiguousarray(bounds)), text]
            rows = pa.Array.from_buffers(value.type, len(first), buffers)
            places = pa.array(first)
            yield pa.RecordBatch.from_arrays([*(c.take(places) for c in kept), rows], _RECORD_NAMES)
