"""Exact token counts of a byte-level BPE tokenizer.

Most words of a corpus repeat, so a text is cut where a single space stands
between two characters that are no white space: there a new pre-token begins
whatever surrounds it, and merges never cross pre-tokens.  The counts of pieces
are kept from text to text.

Huge texts are encoded in overlapping chunks with offsets.  Two neighbours are
spliced at a boundary that is proven to be one of the whole text: a pre-token
starts there in both, and in the left chunk it follows no white space and lies
further from the end than anything the split may look ahead for.  Since the split
is a function of the text from there on, the right chunk goes on as the whole text
would.  Where an overlap holds no such place it is widened, at last to a longer
left chunk.
"""

from __future__ import annotations

import os
import re
from collections.abc import Iterator
from itertools import chain
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import hold, ready

CHUNK_CHARS = 32_768
OVERLAP_CHARS = 512
#: Longer than a special token's text and what the split looks ahead.
LOOK_AHEAD = 16
_PIECES_KEPT = 300_000
_CUT = re.compile(r"(?<=\S) (?=\S)")
_ODD_SPACE = re.compile(r"\s | \s")

_tokenizers: dict[str, object] = {}
_counts: dict[str, dict[str, int]] = {}


def _forget() -> None:
    _tokenizers.clear()
    _counts.clear()


def _tokenizer(content: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    hold("tokens", _forget)
    if content not in _tokenizers:
        from tokenizers import Tokenizer

        _forget()
        made = Tokenizer.from_str(content)
        made.no_truncation()
        made.no_padding()
        _tokenizers[content], _counts[content] = made, {}
    return _tokenizers[content], _counts[content]


class _Chunk:
    """The tokens of text[begin:end], with the places where pre-tokens start."""

    def __init__(self, tokenizer, text: str, begin: int, end: int):
        encoded = tokenizer.encode(text[begin:end], add_special_tokens=False)
        self.begin, self.end, self.size = begin, end, len(encoded.ids)
        words, offsets = encoded.word_ids, encoded.offsets
        self.starts: dict[int, int] = {}
        for i in range(self.size):
            if i == 0 or words[i] is None or words[i] != words[i - 1]:
                self.starts.setdefault(begin + offsets[i][0], i)


def _splice(text: str, left: _Chunk, right: _Chunk, after: int) -> int | None:
    """The last proven boundary of both chunks behind ``after``."""
    for place in reversed(left.starts):
        if place <= max(after, right.begin):
            return None
        if (
            place + LOOK_AHEAD <= left.end
            and place in right.starts
            and not text[place - 1].isspace()
        ):
            return place
    return None


def count_huge(tokenizer, text: str, chunk: int = CHUNK_CHARS, overlap: int = OVERLAP_CHARS) -> int:
    """Tokens of a text, never encoding more than a few chunks at once where it can be cut."""
    total, proven, span = 0, 0, chunk
    left = _Chunk(tokenizer, text, 0, min(span, len(text)))
    while left.end < len(text):
        shared, place = overlap, None
        while place is None and shared <= (left.end - proven) // 2:
            begin = left.end - shared
            right = _Chunk(tokenizer, text, begin, min(begin + chunk, len(text)))
            place = _splice(text, left, right, proven) if right.end > left.end else None
            shared *= 2
        if place is None:
            span *= 2
            left = _Chunk(tokenizer, text, left.begin, min(left.begin + span, len(text)))
            continue
        total += left.starts[place] - left.starts.get(proven, 0)
        left, proven, span = right, place, chunk
    return total + left.size - left.starts.get(proven, 0)


def _pieces(text: str) -> list[str]:
    return _CUT.split(text) if _ODD_SPACE.search(text) else text.split(" ")


def count_texts(tokenizer, known: dict[str, int], texts: list[str | None], chunk: int) -> list[int]:
    """Tokens of each text; ``known`` keeps the counts of pieces that follow a space."""
    cut = [_pieces(t) if t and len(t) <= chunk else [] for t in texts]
    if len(known) > _PIECES_KEPT:
        known.clear()
    new = list(set(chain.from_iterable(p[1:] for p in cut)).difference(known))
    for piece, encoded in zip(
        new,
        tokenizer.encode_batch_fast([" " + p for p in new], add_special_tokens=False),
        strict=True,
    ):
        known[piece] = len(encoded)
    firsts = tokenizer.encode_batch_fast([p[0] if p else "" for p in cut], add_special_tokens=False)
    return [
        count_huge(tokenizer, text, chunk)
        if text and len(text) > chunk
        else len(first) + sum(map(known.__getitem__, pieces[1:]))
        for text, first, pieces in zip(texts, firsts, cut, strict=True)
    ]


def _counted(batches: Iterator[pa.RecordBatch], content: str, chunk: int):
    tokenizer, known = _tokenizer(content)
    for batch in batches:
        counts = count_texts(tokenizer, known, batch.column(2).to_pylist(), chunk)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(counts, pa.int64())],
            names=["doc_id", "n_bytes", "n_tokens"],
        )


def token_counts(
    documents: DataFrame,
    tokenizer_file: str,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    limit: int = 512,
    chunk_chars: int = CHUNK_CHARS,
) -> DataFrame:
    """One row per row of documents: doc_id, n_bytes, n_tokens, over_limit.

    ``tokenizer_file`` is a .json file of a byte-level BPE tokenizer; its content
    goes to the executors.  Texts are counted whole, as the tokenizers library
    does by default without added special tokens: the text of a special token
    inside a document is one token.  A null or empty text has 0 bytes and 0
    tokens; a null id stays null; repeated rows are counted each; an empty table
    gives an empty result; other columns are not looked at.
    """
    ready(documents.sparkSession)
    content = Path(tokenizer_file).read_text(encoding="utf-8")
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.coalesce(F.octet_length(text_column), F.lit(0)).cast("long").alias("n_bytes"),
        F.col(text_column).cast("string").alias("text"),
    )
    return texts.mapInArrow(
        lambda batches: _counted(batches, content, chunk_chars),
        "doc_id long, n_bytes long, n_tokens long",
    ).withColumn("over_limit", F.col("n_tokens") > limit)
