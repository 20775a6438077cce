"""Segmentations against all paths of small texts, and exact round trips."""

from __future__ import annotations

import functools
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

from lendscope.llm import pieces as pieces_module
from lendscope.llm.pieces import (
    MARK,
    Encoder,
    LongUnit,
    best_paths,
    decode,
    decoded,
    encode,
    ordered_paths,
    units_of,
)

MODEL = public_tokenizers.path("piece_bpe_32k.model")
PARTS = ["a", "the", " ", "  ", "\n", "é", "日本", "ing", "😀", "\x00", ".", MARK, "ß", "12", "\t"]


@pytest.fixture(scope="module")
def content():
    return Path(MODEL).read_bytes()


@pytest.fixture(scope="module")
def encoder(content):
    return Encoder(content, 4)


def test_few_hashes_look_into_further_tables(content, monkeypatch):
    pieces = pieces_module.Pieces(content)
    looked = []
    slots = pieces_module.Pieces._slots
    monkeypatch.setattr(
        pieces_module.Pieces,
        "_slots",
        staticmethod(lambda hashes, table: looked.append(hashes.size) or slots(hashes, table)),
    )
    known = []
    for piece in pieces.known:
        value = np.uint64(0)
        with np.errstate(over="ignore"):
            for code in pieces_module._codes(piece):
                value = value * pieces_module._STEP + code
        known.append(value)
    absent = np.random.default_rng(5).integers(0, 1 << 63, 100_000, dtype=np.uint64)
    hashes = np.concatenate([np.array(known, np.uint64), absent, np.zeros(1, np.uint64)])
    expected = [*pieces.known.values(), *[-1] * (len(absent) + 1)]
    assert pieces.find(hashes).tolist() == expected
    assert sum(looked) < 1.2 * len(hashes)
    looked.clear()
    assert pieces.find(hashes[:12].reshape(3, 4)).tolist() == [expected[:4], expected[4:8], expected[8:12]]
    assert pieces.find(hashes[:0]).tolist() == []


def all_scores(pieces, text):
    """Scores of all segmentations of the marked text."""
    marked = MARK + text.replace(" ", MARK)

    @functools.cache
    def from_place(at):
        if at == len(marked):
            return (0.0,)
        found = []
        for size in range(1, min(pieces.longest, len(marked) - at) + 1):
            piece = pieces.known.get(marked[at : at + size])
            if piece is not None:
                score = float(pieces.scores[piece])
            elif size == 1:
                score = pieces.unknown
            else:
                continue
            found += [score + rest for rest in from_place(at + size)]
        return tuple(sorted(found, reverse=True)[:4])

    return from_place(0)


def texts(n, length, seed=1):
    drawn = random.Random(seed)
    return ["".join(drawn.choice(PARTS) for _ in range(drawn.randint(1, length))) for _ in range(n)]


def test_scores_are_the_best_of_all_paths(encoder):
    made = texts(300, 8)
    for text, (ids, score, others) in zip(made, encoder.encode(made), strict=True):
        expected = all_scores(encoder.pieces, text)
        found = [score, *[o["score"] for o in others]]
        assert found == pytest.approx(list(expected), rel=1e-12)
        for other in others:
            changed = ids.tolist()
            for change in sorted(other["changes"], key=lambda c: -c["first"]):
                changed[change["first"] : change["first"] + change["n"]] = change["ids"]
            assert changed != ids.tolist()
            assert b"".join(encoder.pieces.text[i] for i in changed) == b"".join(
                encoder.pieces.text[i] for i in ids.tolist()
            )


def test_units_join_to_the_marked_text():
    for text in texts(500, 12, 2):
        assert "".join(units_of(text)) == MARK + text.replace(" ", MARK)


def test_batches_do_not_matter(content):
    made = texts(200, 20, 3)
    one, other = Encoder(content, 3), Encoder(content, 3)
    together = one.encode(made)
    apart = [other.encode([t])[0] for t in made]
    for a, b in zip(together, apart, strict=True):
        assert a[0].tolist() == b[0].tolist() and a[1] == b[1]


def test_paths_come_in_order(encoder):
    found = [score for score, _ in ordered_paths(encoder.pieces, MARK + "nation", 12)]
    assert found == sorted(found, reverse=True) and len(found) == 12


def test_table_and_round_trip(spark):
    rows = [(1, "a  b\n日 c", 3), (2, None, 4), (None, "", 5), (3, "x " * 20_000, 6), (1, "a", 7),
            (4, "lower퟿é\x00", 1), (5, "q" * 5000, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids int")
    made = encode(docs, MODEL)
    assert made.where("not round_trip").count() == 0
    back = {(r["doc_id"], r["text"]) for r in decode(made, MODEL).collect()}
    assert back == {(i, t or "") for i, t, _ in rows}
    assert encode(docs.limit(0), MODEL).count() == 0
    sizes = {r["doc_id"]: r["n_pieces"] for r in made.where("doc_id > 1 and doc_id < 3").collect()}
    assert sizes == {2: 0}


def test_long_units_by_blocks_equal_whole_ones(encoder):
    drawn = random.Random(8)
    letters = ["a", "e", "the", "ing", "é", "日", "x", "q", "1", "😀", "aaaa", "tion"]
    for _ in range(60):
        unit = "".join(drawn.choices(letters, k=drawn.randint(1, 60)))
        (best,), (total,), (gap,) = best_paths(encoder.pieces, [unit])
        listed = ordered_paths(encoder.pieces, unit, 5)
        for block in (1, 7, 1000):
            long = LongUnit(encoder.pieces, unit, block)
            others = long.others(4)
            assert long.path().tolist() == best and long.total == total
            assert len(others) == len(listed) - 1
            scores = [total] + [total - cost for cost, _ in others]
            assert scores == pytest.approx([score for score, _ in listed])
            if others:
                assert others[0][0] == pytest.approx(gap)
            else:
                assert gap == float("inf")
            spelled = {tuple(long.path(turns).tolist()) for _, turns in others}
            assert len(spelled) == len(others) and tuple(best) not in spelled
            for ids in spelled:
                assert decoded(encoder.pieces, list(ids)) == unit.removeprefix(" ")


def test_long_units_in_a_text(content, monkeypatch):
    rows = ["ab" * 40 + " the end", "the" * 50, "x y z " + "日本" * 30 + "\nab"]
    whole = [(a.tolist(), s, [o["score"] for o in c]) for a, s, c in Encoder(content, 4).encode(rows)]
    monkeypatch.setattr(pieces_module, "_LONG", 50)
    cut = [(a.tolist(), s, [o["score"] for o in c]) for a, s, c in Encoder(content, 4).encode(rows)]
    for (ids, score, others), (own, own_score, own_others) in zip(whole, cut, strict=True):
        assert own == ids and own_score == pytest.approx(score)
        assert own_others == pytest.approx(others)


def test_two_million_characters_without_a_space():
    """In a process of its own, whose memory can be measured."""
    program = """
import random, resource, sys
from lendscope.llm.pieces import Encoder, decoded
encoder = Encoder(open(sys.argv[1], "rb").read(), 3)
before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
text = "".join(random.Random(3).choices("etaoinshrdlucmfw", k=2_000_000))
((ids, score, others),) = encoder.encode([text])
grown = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before
assert len(others) == 2 and score >= others[0]["score"] >= others[1]["score"]
print(grown // 1024)
assert decoded(encoder.pieces, ids.tolist()) == text
"""
    done = subprocess.run(
        [sys.executable, "-c", program, MODEL], capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 500
