"""The trie against a plain one, on awkward, deep and common conversations."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from lendscope.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, key string, level int"


def plain(rows):
    """Nodes as tuples, built conversation by conversation."""
    turns = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            turns.setdefault(conv, []).append((turn, role or "", text or ""))
    order = lambda t: (
        t[0] is not None, t[0] or 0, t[1], hashlib.sha256(t[2].encode()).digest()
    )
    own = {c: [t[1:] for t in sorted(ts, key=order)] for c, ts in turns.items()}
    nodes = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        whole = tuple(own.get(c - c % 100, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            node = nodes.setdefault(whole[:d], {"members": [], "ends": []})
            node["members"].append(c)
        nodes[whole]["ends"].append(c)
    kids = {}
    for path in nodes:
        if path:
            kids[path[:-1]] = kids.get(path[:-1], 0) + 1
    for path in sorted(nodes, key=len, reverse=True):
        node = nodes[path]
        node["leaves"] = node.get("leaves", 0) + (path not in kids)
        chars = len(path[-1][1]) if path else 0
        node["saved"] = node.get("saved", 0) + (len(node["members"]) - 1) * chars
        if path:
            parent = nodes[path[:-1]]
            parent["leaves"] = parent.get("leaves", 0) + node["leaves"]
            parent["saved"] = parent.get("saved", 0) + node["saved"]
    return sorted(
        (
            min(node["members"]), len(path),
            min(nodes[path[:-1]]["members"]) if path else -1,
            len(node["members"]), kids.get(path, 0), node["leaves"], node["saved"],
            hashlib.sha256(",".join(map(str, sorted(node["ends"]))).encode()).hexdigest(),
        )
        for path, node in nodes.items()
    )


def found(spark, rows, **options):
    given = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    got = prefix_trie.prefix_trie(given, **options).collect()
    return sorted(tuple(-1 if v is None else v for v in r) for r in got)


def test_empty_table_has_no_node(spark):
    assert found(spark, []) == []
    assert found(spark, [(None, 1, "user", "a")]) == []


def test_nulls_ties_and_repeated_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 0, None, None), (1, 0, "a", ""),
        (1, 0, "a", "z"), (1, 0, "a", "b"), (2, 5, "user", "x"), (2, None, None, "x"),
        (100, 1, "user", "é" * 5), (101, 1, "other", "gone"), (199, 1, "user", "mine"),
        (150, 1, "user", "a"), (300, 1, "user", "alone"), (None, 1, "user", "none"),
        (7, None, "a:b", "c"), (8, None, "a", "b:c"), (9, None, "", ""), (9, 1, "", ""),
    ]
    assert found(spark, rows) == plain(rows)


@pytest.mark.parametrize("band", [2, 8])
def test_random_conversations(spark, band):
    drawn = random.Random(band)
    rows = [
        (c, t, drawn.choice(["user", "assistant"]), drawn.choice(["", "a", "bb"]))
        for c in range(0, 640, 2)
        for t in range(drawn.choice([0, 1, 3, 9, 20]))
    ]
    rows += [(c, t, "user", "common") for c in range(1000, 1300) for t in range(7)]
    assert found(spark, rows, band=band) == plain(rows)


def test_conversations_longer_than_a_piece(spark, monkeypatch):
    """Numbers, prefixes and totals cross pieces and bands; ids fill several lists."""
    monkeypatch.setattr(prefix_trie, "_PIECE", 16)
    monkeypatch.setattr(prefix_trie, "_IDS", 16)
    rows = [(c, t, "user", f"t{t}" if t < 150 else f"c{c}") for c in (3, 4) for t in range(170)]
    rows += [(c, t, "user", "same") for c in range(200, 290) for t in range(3)]
    assert found(spark, rows, band=4) == plain(rows)


def test_one_long_conversation(spark):
    rows = [(100, t, "user", "again") for t in range(3000)]
    got = found(spark, rows)
    assert len(got) == 3001 and {r[5] for r in got} == {1}
    assert got == plain(rows)
