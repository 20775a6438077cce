"""Near-duplicate groups against all pairs of small sets."""

from __future__ import annotations

import random

import numpy as np
import pytest

from lendscope.llm import near_dedup
from lendscope.llm.near_dedup import least_matches, near_duplicates, shingle_hashes


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return lowered.encode().split()


def shingles(text, width):
    w = words(text)
    if not w:
        return frozenset()
    size = min(width, len(w))
    return frozenset((size == width, tuple(w[i : i + size])) for i in range(len(w) - size + 1))


def brute(rows, width, percent=80):
    """(doc_id, n, component, kept) by comparing all pairs."""
    sets = [(i, shingles(t, width)) for i, t in rows]
    ids = [i for i, s in sets if s and i is not None]
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    filled = [(i, s) for i, s in sets if s and i is not None]
    for k, (i, s) in enumerate(filled):
        for j, t in filled[:k]:
            if 100 * len(s & t) >= percent * len(s | t):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    found = []
    for i, s in sets:
        component = i if i is None or not s else find(i)
        found.append((i, len(s), component, i is not None and i == component))
    return sorted(found, key=str)


def edited(drawn, base, share):
    vocabulary = [f"v{k}" for k in range(400)]
    return [w if drawn.random() > share else drawn.choice(vocabulary) for w in base]


def made(groups, size, share, seed=3):
    drawn = random.Random(seed)
    texts = []
    for _ in range(groups):
        base = [f"v{drawn.randint(0, 400)}" for _ in range(drawn.randint(30, 120))]
        texts += [" ".join(edited(drawn, base, drawn.random() * share)) for _ in range(size)]
    drawn.shuffle(texts)
    return list(enumerate(texts))


def run(spark, rows, **settings):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates(docs, **settings)
    return sorted(map(tuple, found.collect()), key=str)


@pytest.mark.parametrize("width, seed", [(2, 3), (5, 4)])
def test_groups_equal_all_pairs(spark, width, seed):
    rows = made(6, 14, 0.12, seed) + [(1000 + i, t) for i, t in made(20, 1, 0)]
    assert run(spark, rows, width=width) == brute(rows, width)


def test_one_large_group_of_near_copies(spark):
    """Many variants around the threshold: pivots link some, the last join the others."""
    rows = made(1, 150, 0.25, 9)
    assert run(spark, rows) == brute(rows, 2)


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    rows = [
        (5, None), (4, ""), (3, " \t\n"), (9, "One"), (8, "one "), (7, "one two"), (6, "ONE TWO"),
        (7, "one two"), (None, "one two"), (None, None), (20, long), (21, long + " end"),
        (30, "İ é É"), (31, "i̇ é é"), (40, "a b a b a b"), (41, "a b a"), (42, "one one"),
    ]
    assert run(spark, rows) == brute(rows, 2)


def test_ids_with_several_texts_are_one_document(spark):
    rows = [(1, "a b c d"), (1, "e f g h"), (2, "a b c d"), (3, "e f g h")]
    assert {r[2] for r in run(spark, rows)} == {1}


def test_empty_table_and_clashing_columns(spark):
    docs = spark.createDataFrame(
        [(1, "a b", 7, "x")], "doc_id long, text string, n_shingles int, component_id string"
    )
    assert [tuple(r) for r in near_duplicates(docs).collect()] == [(1, 1, 1, True)]
    assert near_duplicates(docs.limit(0)).collect() == []


def test_hashes_are_as_many_as_shingles():
    for text in ("a", "a b", "a b c a b c", "x " * 50, "p q r s t"):
        for width in (1, 2, 5):
            assert len(shingle_hashes(text, width)) == len(shingles(text, width))


def test_agreements_follow_similarity():
    """Estimated similarity is near the true one, and the threshold leaves room."""
    factors = near_dedup._multipliers(near_dedup.COORDINATES)
    drawn = np.random.default_rng(2)
    agreed = []
    for _ in range(60):
        both = drawn.integers(0, 1 << 63, 800, dtype=np.uint64) * np.uint64(2)
        one, other = (drawn.integers(0, 1 << 63, 100, dtype=np.uint64) for _ in range(2))
        a = near_dedup.signature(np.concatenate([both, one]), factors)
        b = near_dedup.signature(np.concatenate([both, other]), factors)
        agreed.append((a == b).sum())
    assert abs(np.mean(agreed) / near_dedup.COORDINATES - 0.8) < 0.02
    assert min(agreed) >= least_matches(near_dedup.COORDINATES, 80)


@pytest.mark.parametrize("split", [3, 500])
def test_lists_dealt_in_parts(spark, monkeypatch, split):
    """A templated group just below and above the threshold, in lists of many parts."""
    monkeypatch.setattr(near_dedup, "SPLIT", split)
    drawn = random.Random(12)
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(edited(drawn, base, drawn.choice([0.02, 0.05, 0.08])))) for i in range(150)]
    assert run(spark, rows) == brute(rows, 2)
