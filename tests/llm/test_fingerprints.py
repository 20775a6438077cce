"""Entropies by counting, edited texts by sorting, and likenesses of what is alike."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import numpy as np
import pytest

from lendscope.llm import fingerprints as fp


def plain_level(window: bytes) -> int:
    terms = sum(int(fp._TERMS[n]) for n in Counter(window).values())
    return (fp._MOST - terms) * (fp.LEVELS - 1) // fp._MOST


def test_levels_equal_counting(monkeypatch):
    monkeypatch.setattr(fp, "_BLOCK", 50)
    drawn = random.Random(1)
    texts = [bytes(drawn.choices(b"aabc \xc3\xa9", k=n)) for n in (0, 1, 15, 16, 17, 200, 500)]
    texts = [t for t in texts if t] + [b"a" * 150, bytes(range(200))]
    laid, begins, lengths = fp._laid_out(texts)
    levels = fp.entropy_levels(laid, begins, lengths)
    for text, begin in zip(texts, begins, strict=True):
        expected = [plain_level(text[i : i + fp.WINDOW]) for i in range(len(text) - fp.WINDOW + 1)]
        assert levels[begin : begin + len(expected)].tolist() == expected
        assert (levels[begin + len(expected) : begin + len(text)] == -1).all()


def ranks():
    found = np.arange(fp.LEVELS, dtype=np.int64)[::-1].copy()
    found[: int(fp.LEAST_ENTROPY * fp.LEVELS)] = fp.LEVELS
    return found


def prose(drawn, n):
    return " ".join("".join(drawn.choices("etaoinshr", k=drawn.randint(2, 9))) for _ in range(n))


def test_batches_do_not_matter():
    drawn = random.Random(2)
    texts = [prose(drawn, n).encode() for n in (1, 5, 30, 90, 400, 3000)] + [b"", b"x", b"a" * 999]
    together = fp.fingerprints(texts, ranks())
    for text, found in zip(texts, together, strict=True):
        assert (fp.fingerprints([text], ranks())[0] == found).all()
        assert (fp.from_text(fp.as_text(found)) == found).all()


def plain_features(text: bytes, order) -> list[bytes]:
    """Windows that are the rarest, and of those the first, of some neighbours."""
    text = text.ljust(fp.WINDOW, b"\0")
    windows = [text[i : i + fp.WINDOW] for i in range(len(text) - fp.WINDOW + 1)]
    keys = [(order[plain_level(w)], i) for i, w in enumerate(windows)]
    places = {min(keys[i : i + fp.NEIGHBOURS])[1] for i in range(len(keys))}
    return list(dict.fromkeys(windows[i] for i in sorted(places)))


def test_features_equal_counting():
    drawn = random.Random(4)
    texts = [prose(drawn, n).encode() for n in (1, 2, 3, 9, 40, 200)]
    texts += [b"x", b"a" * 400, b"ab" * 100 + bytes(range(256)), ("é日" * 50).encode()]
    found = fp._features(texts, ranks())
    for text, own in zip(texts, found, strict=True):
        rows = np.frombuffer(b"".join(plain_features(text, ranks())), np.uint8)
        expected = fp._hash_rows(np.ascontiguousarray(rows.reshape(-1, fp.WINDOW)))
        assert own.tolist() == expected.tolist()
        bits = {
            (k // fp.FILTER_FEATURES, int(h >> np.uint64(11 * i)) % fp.FILTER_BITS)
            for k, h in enumerate(expected)
            for i in range(fp.FEATURE_BITS)
        }
        assert set(zip(*map(list, np.nonzero(fp._filters(own))), strict=True)) == bits


@pytest.mark.parametrize("n", [8, 16, 20, 25, 30, 40, 60, 100, 200, 640, 2000])
def test_likeness(n):
    """The same rule at every length: no text is farther from its edit than from another."""
    for seed in range(40 if n < 640 else 5):
        drawn = random.Random(f"{seed} {n}")
        text, other = prose(drawn, n), prose(drawn, n)
        edited = text[: len(text) - len(text) // 3] + other[: len(text) // 3]
        a, b, c = fp.fingerprints([t.encode() for t in (text, edited, other)], ranks())
        assert fp.likeness(a, a) == 1.0
        assert fp.likeness(a, b) == pytest.approx(fp.likeness(b, a))
        assert fp.likeness(a, b) > fp.likeness(a, c) < 0.25
        assert n < 16 or fp.likeness(a, b) > 0.35
    empty = fp.fingerprints([b""], ranks())[0]
    assert fp.likeness(empty, empty) == 1.0 and fp.likeness(empty, a) == 0.0


def expected_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), (r[1] is not None, r[1] or "")))
    found = []
    for k, (i, text) in enumerate(order):
        text, behind = text or "", order[(k + 1) % len(order)][1] or ""
        size = len(text) // 3
        edited = text[: len(text) - size] + behind[:size]
        found.append((i, len(text), hashlib.sha256(edited.encode()).hexdigest()))
    return sorted(found, key=str)


@pytest.mark.parametrize("count", [1, 2, 700])
def test_edited_texts(spark, count):
    drawn = random.Random(count)
    rows = [(drawn.randint(-(10**12), 10**12), prose(drawn, drawn.randint(0, 40))) for _ in range(count)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = fp.fingerprint_documents(docs).collect()
    assert sorted([tuple(r)[:3] for r in found], key=str) == expected_edits(rows)


def test_odd_rows(spark):
    rows = [(4, None, 1), (3, "", 1), (3, "é日😀" * 50, 1), (3, "é日😀" * 50, 2), (None, "abc", 1),
            (9, "word " * 30_000, 1), (1, "q", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint int")
    found = fp.fingerprint_documents(docs).collect()
    assert sorted([tuple(r)[:3] for r in found], key=str) == expected_edits([r[:2] for r in rows])
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in found)
    same = {r["fingerprint"] for r in found if r["doc_id"] == 3 and r["n_chars"]}
    assert len(same) == 1
    assert fp.fingerprint_documents(docs.limit(0)).collect() == []


def test_ranks_count_all_windows(spark):
    rows = [(1, "a" * 100), (2, prose(random.Random(1), 100)), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = fp.entropy_ranks(docs)
    assert (found[: int(fp.LEAST_ENTROPY * fp.LEVELS)] == fp.LEVELS).all()
    text = rows[1][1].encode()
    levels = Counter(plain_level(text[i : i + fp.WINDOW]) for i in range(len(text) - fp.WINDOW + 1))
    ordered = sorted(levels, key=lambda x: (levels[x], x))
    assert [found[x] for x in ordered] == sorted(found[x] for x in ordered)
    assert math.isclose(sum(levels.values()), len(text) - fp.WINDOW + 1)
