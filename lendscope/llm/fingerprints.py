"""Similarity digests of documents from their improbable features.

Every window of 16 bytes has an entropy; how rare that entropy is among all windows
of all documents is the window's rank.  A window that is the rarest of some eight that
follow each other is a feature, in texts of every length.  Features go, in order, into a chain of
Bloom filters, a full one making room for the next.  Two digests are compared
filter by filter: the shared bits beyond what chance gives, as a share of the most
there could be.

Entropies of a whole batch are computed at once: a byte's count among its
neighbours comes from comparing the batch with itself at 15 distances, and an
entropy changes from window to window by what enters and leaves.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import ready, stored

#: Bytes of a window; a text of fewer is padded to one.
WINDOW = 16
#: A feature is the rarest of so many windows that follow each other, somewhere in the text.
NEIGHBOURS = 8
#: The bits of a filter are a power of two.
FILTER_BITS, FEATURE_BITS, FILTER_FEATURES = 2048, 4, 256
LEVELS = 1024
#: Windows of less entropy, as a share of the most, come behind all others.
LEAST_ENTROPY = 0.2
_UNIT = 1 << 16
_TERMS = np.array([round(n * np.log2(n) * _UNIT) if n else 0 for n in range(WINDOW + 1)], np.int64)
_MOST = int(_TERMS[WINDOW])
_STEPS = np.diff(_TERMS).astype(np.int32)
_GAP = 256
_BLOCK = 1 << 15
_NEVER = np.int64(1) << np.int64(31)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _laid_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All texts in one array, gaps between them; where each begins, and its length."""
    lengths = np.array([len(t) for t in texts], np.int64)
    begins = np.cumsum(lengths + WINDOW) - lengths
    laid = np.full(int(lengths.sum()) + WINDOW * (len(texts) + 1), _GAP, np.uint16)
    for text, begin in zip(texts, begins, strict=True):
        laid[begin : begin + len(text)] = np.frombuffer(text, np.uint8)
    return laid, begins, lengths


def entropy_levels(laid: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Entropy level of the window that begins at each place, or -1 where none does."""
    before = np.zeros(len(laid), np.uint8)
    behind = np.zeros(len(laid), np.uint8)
    for start in range(0, len(laid), _BLOCK):
        end = min(start + _BLOCK, len(laid))
        for lag in range(1, min(WINDOW, end)):
            first = max(start, lag)
            same = (laid[first:end] == laid[first - lag : end - lag]).view(np.uint8)
            before[first:end] += same
            behind[first - lag : end - lag] += same
    enters = np.cumsum(_STEPS[before], dtype=np.int64)
    leaves = np.cumsum(_STEPS[behind], dtype=np.int64)
    levels = np.full(len(laid), -1, np.int32)
    for begin, length in zip(begins.tolist(), lengths.tolist(), strict=True):
        count = length - WINDOW + 1
        if count < 1:
            continue
        # All that has entered by a window's end less all that has left by its start.
        gone = leaves[begin - 1 : begin - 1 + count] - leaves[begin - 1]
        terms = enters[begin + WINDOW - 1 : begin + length] - enters[begin - 1] - gone
        levels[begin : begin + count] = (_MOST - terms) * (LEVELS - 1) // _MOST
    return levels


def _features(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Feature hashes of each text, in order, each once; the same rule at every length."""
    laid, begins, lengths = _laid_out([t.ljust(WINDOW, b"\0") for t in texts])
    levels = entropy_levels(laid, begins, lengths)
    some = levels >= 0
    rank = np.where(some, ranks[levels], _NEVER)
    keys = (rank << np.int64(31)) | np.arange(len(laid), dtype=np.int64)
    # The least key of the neighbours, by doubling; what is behind the end never wins.
    least = np.concatenate([keys, np.full(NEIGHBOURS, np.iinfo(np.int64).max)])
    span = 1
    while span < NEIGHBOURS:
        least[:-span] = np.minimum(least[:-span], least[span:])
        span *= 2
    rarest = np.zeros(len(laid), bool)
    rarest[least[: len(laid)][some] & ((1 << 31) - 1)] = True
    places = np.flatnonzero(rarest)
    data = laid.astype(np.uint8)
    chosen = np.lib.stride_tricks.sliding_window_view(data, WINDOW)[places]
    hashed = _hash_rows(np.ascontiguousarray(chosen))
    cuts = np.searchsorted(places, [begins, begins + lengths])
    found = []
    for a, b in zip(*cuts, strict=True):
        mine = hashed[a:b]
        found.append(mine[np.sort(np.unique(mine, return_index=True)[1])])
    return found


def _hash_rows(rows: np.ndarray) -> np.ndarray:
    parts = rows.view(np.uint64).reshape(len(rows), rows.shape[1] // 8)
    value = np.zeros(len(rows), np.uint64)
    for k in range(parts.shape[1]):
        value = (value ^ parts[:, k]) * _MIX
        value ^= value >> np.uint64(29)
    return value * _MIX


def _filters(features: np.ndarray) -> np.ndarray:
    """The chain of Bloom filters, (filter, bit)."""
    chain = np.zeros((-(-len(features) // FILTER_FEATURES), FILTER_BITS), bool)
    begins = np.arange(len(features)) // FILTER_FEATURES * FILTER_BITS
    bits = chain.reshape(-1)
    for k in range(FEATURE_BITS):
        bit = (features >> np.uint64(11 * k)) & np.uint64(FILTER_BITS - 1)
        bits[begins + bit.astype(np.int64)] = True
    return chain


def fingerprints(texts: list[bytes], ranks: np.ndarray) -> list[np.ndarray]:
    """Filters of each text; an empty text has none."""
    filled = [t for t in texts if t]
    found = iter(_features(filled, ranks) if filled else [])
    return [_filters(next(found)) if t else np.zeros((0, FILTER_BITS), bool) for t in texts]


def as_text(chain: np.ndarray) -> str:
    """A digest as text."""
    return base64.b64encode(np.packbits(chain, axis=1).tobytes()).decode()


def from_text(text: str) -> np.ndarray:
    """A digest from its text."""
    data = np.frombuffer(base64.b64decode(text), np.uint8)
    return np.unpackbits(data.reshape(-1, FILTER_BITS // 8), axis=1).astype(bool)


def likeness(one: np.ndarray, other: np.ndarray) -> float:
    """0 for digests that share no more than chance gives, 1 for equal ones.

    Each filter of the shorter chain is held against all of the other, and the best
    matches are averaged by their bits.  Two empty digests are alike, an empty and
    a filled one are not.
    """
    if not len(one) or not len(other):
        return float(len(one) == len(other))
    if one.shape == other.shape and (one == other).all():
        return 1.0
    if (len(one), one.sum()) > (len(other), other.sum()):
        one, other = other, one
    a, b = one.sum(1, dtype=np.int64), other.sum(1, dtype=np.int64)
    shared = one.astype(np.float32) @ other.astype(np.float32).T
    chance = np.outer(a, b) / FILTER_BITS
    # All of a filter's bits can be shared, never more; a small one holds little of a full one.
    score = np.clip((shared - chance) / np.maximum(a[:, None] - chance, 1e-9), 0, 1).max(1)
    return float((score * a).sum() / a.sum())


def _raw(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def _level_counts(batches: Iterator[pa.RecordBatch]):
    total = np.zeros(LEVELS, np.int64)
    for batch in batches:
        texts = [_raw(t) for t in batch.column(0).to_pylist()]
        if texts:
            levels = entropy_levels(*_laid_out(texts))
            total += np.bincount(levels[levels >= 0], minlength=LEVELS)
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.arange(LEVELS), pa.int32()), pa.array(total)], names=["level", "n"]
    )


def entropy_ranks(documents: DataFrame, *, text_column: str = "text") -> np.ndarray:
    """Rank of each entropy level: the rarer among all windows, the smaller.

    One row a level leaves a task.  Levels that tell little come last.
    """
    ready(documents.sparkSession)
    texts = documents.select(F.col(text_column).cast("string").alias("text"))
    counted = texts.mapInArrow(_level_counts, "level int, n long").groupBy("level").agg(F.sum("n"))
    counts = np.zeros(LEVELS, np.int64)
    for level, n in counted.collect():
        counts[level] = n
    order = np.lexsort((np.arange(LEVELS), counts))
    ranks = np.empty(LEVELS, np.int64)
    ranks[order] = np.arange(LEVELS)
    ranks[: int(LEAST_ENTROPY * LEVELS)] = LEVELS
    return ranks


def _with_next(batches: Iterator[pa.RecordBatch], ranks: np.ndarray):
    """Rows in order with the one behind; a head only serves as the one behind."""
    names = [
        "doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next",
    ]
    held: tuple | None = None
    for batch in batches:
        texts = [t or "" for t in batch.column(1).to_pylist()]
        prints = fingerprints([_raw(t) for t in texts], ranks)
        rows = list(
            zip(batch.column(0).to_pylist(), texts, prints, batch.column(2).to_pylist(), strict=True)
        )
        rows = [held, *rows] if held else rows
        held = rows[-1]
        pairs = [(r, s) for r, s in zip(rows[:-1], rows[1:], strict=True) if not r[3]]
        edited = []
        for (_, text, _, _), (_, behind, _, _) in pairs:
            size = len(text) // 3
            edited.append(_raw(text[: len(text) - size] + behind[:size]))
        after = fingerprints(edited, ranks)
        made = [
            (
                row[0],
                len(row[1]),
                hashlib.sha256(new).hexdigest(),
                as_text(row[2]),
                as_text(new_print),
                likeness(row[2], new_print),
                likeness(row[2], behind[2]),
            )
            for (row, behind), new, new_print in zip(pairs, edited, after, strict=True)
        ]
        kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, pa.float64(), pa.float64()]
        columns = list(zip(*made, strict=True)) or [()] * len(names)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names
        )


def _bucketed(batches: Iterator[pa.RecordBatch], bounds: np.ndarray):
    for batch in batches:
        ids = batch.column(0)
        found = np.searchsorted(bounds, ids.fill_null(np.iinfo(np.int64).min).to_numpy(), "right")
        yield pa.RecordBatch.from_arrays(
            [ids, batch.column(1), pa.array(found, pa.int32())], names=["doc_id", "text", "bucket"]
        )


def fingerprint_documents(
    documents: DataFrame,
    *,
    ranks: np.ndarray | None = None,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per document with its digest, its edited text's, and two likenesses.

    doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited,
    near_next.  The edited text has its last floor(n_chars / 3) code points replaced
    by the first as many, or all, of the next document by descending id; the last
    one's next is the first.  ``ranks`` come from all texts unless given.

    A null text is an empty one, whose digest is empty.  Rows with equal ids follow
    each other by their text, null ids come last.  A single row is its own next; an
    empty table gives an empty result; other columns are not looked at.

    Documents are dealt by id into buckets at approximate quantiles and sorted in
    them.  A bucket's last row needs the first of the next one: those, one a
    bucket, are sent along.
    """
    spark = ready(documents.sparkSession)
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )
    ranks = entropy_ranks(texts) if ranks is None else ranks
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    buckets = 4 * parts
    cuts = texts.select(
        F.percentile_approx("doc_id", [k / buckets for k in range(1, buckets)], 100 * buckets)
    ).head()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))

    def dealt(df: DataFrame) -> DataFrame:
        return df.select("doc_id", "text").mapInArrow(
            lambda batches: _bucketed(batches, bounds), "doc_id long, text string, bucket int"
        )

    ids = dealt(texts.select("doc_id", F.lit("").alias("text")))
    # One row a bucket.
    found = ids.groupBy("bucket").agg(F.max("doc_id").alias("head")).collect()
    heads = sorted(((r["bucket"], r["head"]) for r in found), reverse=True)
    order = [b for b, _ in heads]
    serves = [
        (head, order[k - 1]) for k, (_, head) in enumerate(heads)
    ]  # the first one's is the last bucket
    serving = F.broadcast(spark.createDataFrame(serves, "head long, bucket int"))
    behind = texts.join(serving, F.col("doc_id").eqNullSafe(F.col("head"))).select(
        "doc_id", "text", "bucket", F.lit(True).alias("is_head")
    )
    rows = dealt(texts).withColumn("is_head", F.lit(False)).unionByName(behind)
    ordered = (
        rows.select("doc_id", "text", "is_head", "bucket")
        .repartition(parts, "bucket")
        .sortWithinPartitions("bucket", "is_head", F.desc_nulls_last("doc_id"), "text")
    )
    return ordered.mapInArrow(
        lambda batches: _with_next(batches, ranks),
        "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double",
    )
