"""Exponents by their promises, and the realised mixture against the budget."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import pytest

from lendscope.llm.mixing import entropy, mix, shares_at, temper

SIZES = {"a": 7000, "b": 900, "c": 100, None: 40}


def test_target_entropy_is_met():
    for part in (0.6, 0.8, 0.95):
        target = part * math.log(4)
        found = temper(SIZES, 8040, target_entropy=target)
        assert entropy(found.shares) == pytest.approx(max(target, entropy(shares_at(SIZES, 1.0))), abs=1e-6)
        assert sum(found.tokens.values()) == 8040


def test_repeats_are_limited():
    for most in (1.5, 3, 10):
        found = temper(SIZES, 8040, most_repeats=most)
        assert all(found.tokens[s] <= most * n + 1 for s, n in SIZES.items())
        if found.exponent > 1e-9:
            lower = shares_at(SIZES, found.exponent - 1e-3)
            assert any(p * 8040 > most * SIZES[s] for s, p in lower.items())


def test_edges():
    assert temper({}, 10).tokens == {}
    assert temper({"a": 0}, 10).tokens == {"a": 0}
    assert temper({"a": 5, "b": 0}, 7).tokens == {"a": 7, "b": 0}
    assert temper(SIZES, 8040).shares == shares_at(SIZES, 1.0)


def documents(spark, seed=1):
    drawn = random.Random(seed)
    rows = []
    for source, n in (("hot", 600), ("mid", 80), ("small", 12), (None, 9)):
        rows += [(len(rows) + i, "w " * drawn.randint(0, 60), source) for i in range(n)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string"), rows


def test_mixture_fits_the_budget(spark):
    docs, rows = documents(spark)
    tokens = {i: len(t.split()) for i, t, _ in rows}
    sizes = Counter()
    for i, _, s in rows:
        sizes[s] += tokens[i]
    taken = mix(docs, blocks=16).collect()
    wanted = temper(
        sizes, sum(sizes.values()), target_entropy=0.95 * math.log(4), most_repeats=4.0
    ).tokens
    most = max(tokens.values())
    by_source, epochs = Counter(), defaultdict(Counter)
    for r in taken:
        assert r["n_tokens"] == tokens[r["doc_id"]]
        by_source[r["source"]] += r["n_tokens"]
        epochs[r["source"], r["epoch"]][r["doc_id"]] += 1
    for source, n in wanted.items():
        assert n - most < by_source[source] <= n
        mine = {i for i, _, s in rows if s == source}
        last = max(e for s, e in epochs if s == source)
        for (s, e), found in epochs.items():
            if s == source:
                assert set(found.values()) == {1} and set(found) <= mine
                assert e == last or set(found) == mine
    assert sorted(map(str, mix(docs, blocks=16).collect())) == sorted(map(str, taken))


def test_the_last_epoch_is_a_prefix_of_its_permutation(spark):
    docs, rows = documents(spark, 2)
    taken = [r for r in mix(docs, blocks=8).collect() if r["source"] == "hot"]
    assert {r["epoch"] for r in taken} == {0}
    whole = mix(docs.where("source = 'hot'"), blocks=8, budget=1.0).collect()
    order = [r["doc_id"] for r in sorted(whole, key=lambda r: (r["block"], r["position"]))]
    cut = [r["doc_id"] for r in sorted(taken, key=lambda r: (r["block"], r["position"]))]
    tokens = {i: len(t.split()) for i, t, _ in rows}
    last = order.index(cut[-1]) + 1
    skipped = [i for i in order[:last] if i not in set(cut)]
    assert not skipped and tokens


def test_odd_rows(spark):
    rows = [(1, None, None, 5), (2, "", "s", 5), (None, "a b", "s", 5), (3, "a b c", "s", 5),
            (3, "a b c", "s", 5), (4, "w " * 50_000, "t", 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, epoch int")
    taken = mix(docs, most_repeats=None, target_entropy_share=None).collect()
    found = Counter((r["doc_id"], r["copy"]) for r in taken)
    assert found == {(2, 0): 1, (None, 0): 1, (3, 0): 1, (3, 1): 1, (4, 0): 1}
    assert mix(docs.limit(0)).collect() == []
