"""Counts over whole texts, for quality rules and classifiers.

Words are runs without ASCII white space (0x20, 0x09-0x0D); lines are cut at \\n.
Counts of characters come from the bytes of a whole batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import hold, with_row, with_texts, word_hashes

SPACE = b" \t\n\x0b\x0c\r"
SYMBOLS = b"#*$%&|<>"
COUNTS = (
    "n_chars", "word_chars", "n_words", "n_symbols", "n_upper", "n_digits", "n_marks", "n_lines",
    "n_dup_lines", "n_distinct_words", "n_repeat_words",
)
#: Statistics that do not grow with the text: name, numerator, denominator.
RATIOS = (
    ("word_length", "word_chars", "n_words"),
    ("symbol_share", "n_symbols", "n_chars"),
    ("symbols_a_word", "n_symbols", "n_words"),
    ("upper_share", "n_upper", "word_chars"),
    ("digit_share", "n_digits", "word_chars"),
    ("mark_share", "n_marks", "word_chars"),
    ("words_a_line", "n_words", "n_lines"),
    ("dup_line_share", "n_dup_lines", "n_lines"),
    ("distinct_share", "n_distinct_words", "n_words"),
    ("repeat_share", "n_repeat_words", "n_words"),
)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _is(characters: bytes) -> np.ndarray:
    found = np.zeros(256, bool)
    found[list(characters)] = True
    return found


_CLASSES = {
    "n_chars": ~_is(bytes(range(0x80, 0xC0))),
    "spaces": _is(SPACE),
    "n_symbols": _is(SYMBOLS),
    "n_upper": _is(bytes(range(0x41, 0x5B))),
    "n_digits": _is(b"0123456789"),
    "n_marks": _is(b"!?.,;:"),
}


def _class_counts(texts: list[bytes]) -> dict[str, np.ndarray]:
    ends = np.cumsum([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), np.uint8)
    found = {}
    for name, members in _CLASSES.items():
        total = np.concatenate([[0], np.cumsum(members[data], dtype=np.int64)])
        found[name] = np.diff(total[np.concatenate([[0], ends])])
    return found


def _repeated(words: list[bytes]) -> tuple[int, int]:
    """Distinct words; words inside windows of three that occur twice or more."""
    each = np.fromiter(map(word_hashes.__getitem__, words), np.uint64, len(words))
    distinct = len(set(words))
    if len(words) < 4 or distinct == len(words):
        return distinct, 0
    mixed = (each ^ (each >> np.uint64(32))) * _MIX
    windows = ((mixed[:-2] * _MIX + mixed[1:-1]) * _MIX + mixed[2:]) * _MIX
    order = np.argsort(windows)
    same = np.diff(windows[order]) == 0
    again = np.zeros(len(windows), bool)
    again[order[1:][same]] = True
    again[order[:-1][same]] = True
    covered = np.zeros(len(words), bool)
    for k in range(3):
        covered[k : k + len(again)] |= again
    return distinct, int(covered.sum())


def count_all(texts: list[str | None]) -> dict[str, np.ndarray]:
    """The counts named in COUNTS for each text; all 0 for null."""
    hold("hashes", word_hashes.clear)
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    found = _class_counts(raw)
    found["word_chars"] = found["n_chars"] - found.pop("spaces")
    rows = []
    for text in raw:
        words = text.split()
        distinct, repeated = _repeated(words)
        lines = text.split(b"\n") if text else []
        filled = [x for x in lines if x.strip(SPACE)]
        rows.append((len(words), len(lines), len(filled) - len(set(filled)), distinct, repeated))
    names = ("n_words", "n_lines", "n_dup_lines", "n_distinct_words", "n_repeat_words")
    columns = np.array(rows, np.int64).reshape(len(rows), len(names)).T
    return found | dict(zip(names, columns, strict=True))


def _counted(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        found = count_all(batch.column(1).to_pylist())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(found[c], pa.int64()) for c in COUNTS],
             *batch.columns[2:]],
            names=["doc_id", *COUNTS, *batch.schema.names[2:]],
        )


def statistics(
    documents: DataFrame,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: bool = False,
) -> DataFrame:
    """doc_id and the counts of every row of documents; the whole row where carried."""
    texts = with_texts(documents, id_column, text_column, carry)
    schema = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
    return texts.mapInArrow(_counted, with_row(schema, documents, carry))


def ratio_columns() -> list[Column]:
    """RATIOS as columns over the counts; 0 where the denominator is 0."""
    return [
        F.when(F.col(below) > 0, F.col(above) / F.col(below)).otherwise(0.0).alias(name)
        for name, above, below in RATIOS
    ]


def labelled_sample(
    documents: DataFrame, labels: DataFrame, label: str, bound: int, keep: Column | None = None
) -> DataFrame:
    """Documents with the named label, about ``bound`` of them, drawn by a hash of the id.

    Rows without id or label are left out; of a repeated id the largest label counts.
    The drawn ids, bounded as they are, are broadcast to the documents.
    """
    given = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
    if keep is not None:
        given = given.where(keep)
    known = given.groupBy("doc_id").agg(F.max(F.col(label).cast("double")).alias("label"))
    count = given.count()
    draw = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit("sample")), F.lit(1 << 20))
    drawn = known.where(draw < -(-(bound << 20) // max(count, 1))).limit(2 * bound)
    return documents.select("doc_id", "text").join(F.broadcast(drawn), "doc_id")
