"""Token counts equal the library's on whole texts."""

from __future__ import annotations

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from lendscope.llm.token_counts import count_huge, count_texts, token_counts

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = [
    "the", "don't", "we're", "  ", " ", "\n", "\t ", " ", "é", "日本", "12", "3.4", "<|endoftext|>",
    "<|endof", "text|>", "'", "'r", "e", "😀", "\x1c", " ", "a" * 40, " " * 50, "x", "…", "'ll",
]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


def texts(n, length):
    drawn = random.Random(5)
    return ["".join(drawn.choice(PARTS) for _ in range(drawn.randint(0, length))) for _ in range(n)]


def whole(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


def test_pieces_count_like_whole_texts(tokenizer):
    made = texts(600, 30) + [None, "", " ", "a"]
    assert count_texts(tokenizer, {}, made, 10**6) == [whole(tokenizer, t) for t in made]


@pytest.mark.parametrize("chunk, overlap", [(64, 16), (200, 20), (300, 2)])
def test_chunks_count_like_whole_texts(tokenizer, chunk, overlap):
    for text in texts(150, 200):
        assert count_huge(tokenizer, text, chunk, overlap) == whole(tokenizer, text)


@pytest.mark.parametrize("text", ["a" * 3000, " " * 3000, "\n" * 999 + "b", "日" * 2000, "<|endoftext|>" * 300])
def test_texts_without_places_to_cut(tokenizer, text):
    assert count_huge(tokenizer, text, 100, 10) == whole(tokenizer, text)


def test_table(spark, tokenizer):
    rows = [(1, "one two", "x"), (1, "one two", "x"), (None, None, None), (3, "", None), (4, "a b " * 9000, "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    found = token_counts(docs, PATH).orderBy("doc_id").collect()
    assert [tuple(r) for r in found] == [
        (None, 0, 0, False), (1, 7, 2, False), (1, 7, 2, False), (3, 0, 0, False),
        (4, 36000, whole(tokenizer, rows[4][1]), True),
    ]
    assert token_counts(docs.limit(0), PATH).count() == 0
