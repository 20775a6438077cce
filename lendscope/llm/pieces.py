"""The n best segmentations of texts into the pieces of a sentencepiece model, and back.

A text's pieces form a lattice, scored by the sum of the scores stored with the
pieces.  No piece reaches over the place before a space mark or around a line
break, so the lattice is a chain of units, mostly words.  For each distinct unit
of a batch, forward scores give the best path and, with backward scores, the gap to
its second best one.  The n best paths of the text change only units whose gap is
among the n - 1 smallest; for those a search backwards from the unit's end, led by
the forward scores as exact estimates of what is left, lists its paths in order.

Units longer than ``_LONG`` characters, as texts without spaces are, take the same way in
blocks: per character only a score, a back pointer and the lattice's edges stay, some 60 to
150 bytes together, and the search keeps no more open paths than are still wanted.
"""

from __future__ import annotations

import bisect
import heapq
import re
from collections.abc import Iterator
from itertools import chain
from operator import itemgetter
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import hold, ready

MARK = "▁"
#: Scores below this mark pieces that are not meant to be produced.
LEAST_SCORE = -1e8
#: An unknown character costs this much more than the rarest single character.
UNKNOWN_COST = 10.0
_UNITS_KEPT, _OTHERS_KEPT = 200_000, 20_000
_CHARACTERS_KEPT = 4_000_000
_CELLS = 30_000
#: Longer units are taken in blocks of so many characters.
_LONG, _BLOCK = 20_000, 50_000
_UNITS = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
_STEP = np.uint64(1_000_003)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_SLOTS = 18
_ENCODED = (
    "doc_id long, n_pieces long, ids array<int>, score double, alternatives array<struct<"
    "score: double, changes: array<struct<first: long, n: long, ids: array<int>>>>>, "
    "round_trip boolean"
)


def _codes(text: str) -> np.ndarray:
    # From 1 on, so that a NUL in front changes a hash.
    return np.frombuffer(text.encode("utf-32-le"), np.uint32).astype(np.uint64) + np.uint64(1)


class Pieces:
    """The pieces of a model, by text and by hash."""

    def __init__(self, content: bytes):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_proto=content)
        self.text: list[bytes] = []
        self.known: dict[str, int] = {}
        self.byte: dict[int, int] = {}
        self.scores = np.array([model.get_score(i) for i in range(model.get_piece_size())])
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            self.text.append(piece.replace(MARK, " ").encode())
            if model.is_byte(i):
                value = int(piece[1:-1], 16)
                self.byte[value] = i
                self.text[i] = bytes([value])
            elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
                if MARK in piece.lstrip(MARK) or "\n" in piece:
                    raise ValueError(f"a piece reaches over a space or line break: {piece!r}")
                self.known[piece] = i
        if len(self.byte) != 256:
            raise ValueError("the model has no pieces for all bytes")
        self.longest = max(map(len, self.known), default=1)
        single = [
            self.scores[i]
            for p, i in self.known.items()
            if len(p) == 1 and self.scores[i] > LEAST_SCORE
        ]
        self.unknown = min(single, default=0.0) - UNKNOWN_COST
        # With one score more, for no piece.
        self.padded = np.append(self.scores, -np.inf)
        self._tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._hash()

    def _hash(self) -> None:
        """Tables from slots to pieces; a piece whose slot is taken goes to the next one, and
        the slot is marked."""
        left = []
        for piece, i in self.known.items():
            value = np.uint64(0)
            with np.errstate(over="ignore"):
                for code in _codes(piece):
                    value = value * _STEP + code
            left.append((value, i))
        while left:
            hashes = np.zeros(1 << _SLOTS, np.uint64)
            ids = np.full(1 << _SLOTS, -1, np.int32)
            taken = np.zeros(1 << _SLOTS, bool)
            after = []
            slots = self._slots(np.array([h for h, _ in left], np.uint64), len(self._tables))
            for (value, i), slot in zip(left, slots, strict=True):
                if ids[slot] >= 0:
                    taken[slot] = True
                    after.append((value, i))
                else:
                    hashes[slot], ids[slot] = value, i
            self._tables.append((hashes, ids, taken))
            left = after

    @staticmethod
    def _slots(hashes: np.ndarray, table: int) -> np.ndarray:
        return (((hashes + np.uint64(table)) * _MIX) >> np.uint64(64 - _SLOTS)).astype(np.int64)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """Piece of each hash, or -1; only hashes whose slot is marked look into the next table."""
        found = np.full(hashes.size, -1, np.int32)
        left, values = None, hashes.ravel()
        for number, (known, ids, taken) in enumerate(self._tables):
            slots = self._slots(values, number)
            hits = np.flatnonzero(known[slots] == values)
            found[hits if left is None else left[hits]] = ids[slots[hits]]
            more = np.flatnonzero(taken[slots])
            left, values = more if left is None else left[more], values[more]
        return found.reshape(hashes.shape)

    def of_unknown(self, character: str) -> list[int]:
        """An unknown character as byte pieces."""
        return [self.byte[b] for b in character.encode("utf-8", "surrogatepass")]


def best_paths(pieces: Pieces, units: list[str]) -> tuple[list[list[int]], np.ndarray, np.ndarray]:
    """Best path, its score and the gap to the second best, of units of like length."""
    width, count = max(map(len, units)), len(units)
    codes = np.zeros((width, count), np.uint64)
    lengths = np.fromiter(map(len, units), np.int64, count)
    flat = np.array(units, dtype=f"U{width}").view(np.uint32).reshape(count, width)
    codes[:] = flat.T
    codes += np.uint64(1)
    longest = min(pieces.longest, width)
    ids = np.full((longest, width, count), -1, np.int32)
    hashes = np.zeros((width, count), np.uint64)
    for size in range(1, longest + 1):
        hashes = hashes[: width - size + 1] * _STEP + codes[size - 1 :]
        ids[size - 1, : width - size + 1] = pieces.find(hashes)
    edges = pieces.padded[ids]
    inside = np.arange(width)[:, None] < lengths
    edges[0] = np.where(inside & (ids[0] < 0), pieces.unknown, edges[0])

    ahead = np.full((width + 1, count), -np.inf)
    ahead[0] = 0
    by = np.zeros((width + 1, count), np.int64)
    for end in range(1, width + 1):
        sizes = np.arange(1, min(longest, end) + 1)
        options = ahead[end - sizes] + edges[sizes - 1, end - sizes]
        pick = options.argmax(0)
        by[end] = pick + 1
        ahead[end] = options[pick, np.arange(count)]
    back = np.full((width + 1, count), -np.inf)
    back[lengths, np.arange(count)] = 0
    for begin in range(width - 1, -1, -1):
        sizes = np.arange(1, min(longest, width - begin) + 1)
        options = edges[sizes - 1, begin] + back[begin + sizes]
        back[begin] = np.maximum(back[begin], options.max(0))
    total = ahead[lengths, np.arange(count)]

    through = np.full(edges.shape, -np.inf)
    for size in range(1, longest + 1):
        last = width - size + 1
        through[size - 1, :last] = ahead[:last] + edges[size - 1, :last] + back[size:]
    line, at = np.arange(count), lengths.copy()
    steps = []
    while (at > 0).any():
        size = np.where(at > 0, by[at, line], 1)
        begin = np.maximum(at - size, 0)
        steps.append(np.where(at > 0, ids[size - 1, begin, line], -2))
        on = at > 0
        through[size[on] - 1, begin[on], line[on]] = -np.inf
        at = np.where(on, begin, 0)
    second = through.max((0, 1))
    paths = []
    for unit, path in zip(units, np.array(steps)[::-1].T.tolist(), strict=True):
        path = [i for i in path if i != -2]
        if -1 in path:
            spelled: list[int] = []
            place = 0
            for i in path:
                if i >= 0:
                    spelled.append(i)
                    place += _size(pieces, i)
                else:
                    spelled += pieces.of_unknown(unit[place])
                    place += 1
            path = spelled
        paths.append(path)
    return paths, total, total - second


def _size(pieces: Pieces, piece: int) -> int:
    return len(pieces.text[piece].decode())


def ordered_paths(pieces: Pieces, unit: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
    """The n best paths of a unit with their scores, best first.

    The search starts at the end.  A partial path is ranked by its own score and
    the forward score of where it stands, which is the best way left to the start,
    so paths are completed in order.
    """
    ends: list[list[tuple[int, float, tuple[int, ...]]]] = [[] for _ in range(len(unit) + 1)]
    ahead = [0.0] + [-np.inf] * len(unit)
    for begin in range(len(unit)):
        for size in range(1, min(pieces.longest, len(unit) - begin) + 1):
            piece = pieces.known.get(unit[begin : begin + size])
            if piece is not None:
                edge = (begin, float(pieces.scores[piece]), (piece,))
            elif size == 1:
                edge = (begin, pieces.unknown, tuple(pieces.of_unknown(unit[begin])))
            else:
                continue
            ends[begin + size].append(edge)
            ahead[begin + size] = max(ahead[begin + size], ahead[begin] + edge[1])
    found: list[tuple[float, tuple[int, ...]]] = []
    pushed = 0
    # Paths are chains (ids, rest), so a step copies nothing.
    heap: list = [(-ahead[-1], 0, len(unit), 0.0, None)]
    while heap and len(found) < n:
        _, _, at, score, path = heapq.heappop(heap)
        if at == 0:
            ids: list[int] = []
            while path:
                ids += path[0]
                path = path[1]
            found.append((score, tuple(ids)))
            continue
        for begin, value, own in ends[at]:
            pushed += 1
            rank = -(score + value + ahead[begin])
            heapq.heappush(heap, (rank, pushed, begin, score + value, (own, path)))
    return found


class LongUnit:
    """The lattice of a long unit, made block by block, and its paths in order."""

    def __init__(self, pieces: Pieces, unit: str, block: int = _BLOCK):
        self.pieces, self.unit, self.block = pieces, unit, block
        length = len(unit)
        self.sizes: list[np.ndarray] = []
        self.ids: list[np.ndarray] = []
        self.counts: list[np.ndarray] = []
        self.ahead = np.zeros(length + 1)
        self.by = np.zeros(length + 1, np.int32)
        self.of = np.full(length + 1, -1, np.int32)
        window = [0.0]
        for start in range(0, length, block):
            window = self._forward(start, min(start + block, length), window)
        self.total = float(self.ahead[length])

    def _edges(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Begins, sizes and pieces of the edges that begin in a block, in order of begin."""
        codes = _codes(self.unit[start : stop + self.pieces.longest - 1])
        width, longest = stop - start, min(self.pieces.longest, len(codes))
        ids = np.full((width, longest), -1, np.int32)
        hashes = np.zeros(len(codes), np.uint64)
        for size in range(1, longest + 1):
            hashes = hashes[: len(codes) - size + 1] * _STEP + codes[size - 1 :]
            ids[: len(hashes), size - 1] = self.pieces.find(hashes[:width])
        exists = ids >= 0
        exists[:, 0] = True
        begins, sizes = np.nonzero(exists)
        return begins, sizes + 1, ids[begins, sizes]

    def _weights(self, ids: np.ndarray) -> np.ndarray:
        return np.where(ids >= 0, self.pieces.padded[ids], self.pieces.unknown)

    def _forward(self, start: int, stop: int, window: list[float]) -> list[float]:
        """Best scores of the places of a block; ``window`` are those known from before."""
        begins, sizes, ids = self._edges(start, stop)
        room = stop - start + self.pieces.longest + 1
        best = window + [-np.inf] * (room - len(window))
        by = self.by[start : start + len(window)].tolist() + [0] * (room - len(window))
        of = self.of[start : start + len(window)].tolist() + [-1] * (room - len(window))
        edges = zip(
            begins.tolist(), sizes.tolist(), ids.tolist(), self._weights(ids).tolist(), strict=True
        )
        for begin, size, piece, weight in edges:
            score = best[begin] + weight
            # Of equals the shorter last piece, which comes later, wins.
            if score >= best[begin + size]:
                best[begin + size], by[begin + size], of[begin + size] = score, size, piece
        until = min(start + room, len(self.ahead))
        self.ahead[start:until] = best[: until - start]
        self.by[start:until] = by[: until - start]
        self.of[start:until] = of[: until - start]
        self.sizes.append(sizes.astype(np.int8))
        self.ids.append(ids)
        self.counts.append(np.bincount(begins, minlength=stop - start).astype(np.int8))
        return best[stop - start :]

    def path(self, turns: tuple = ()) -> np.ndarray:
        """Ids of the best path or, with turns (end, begin, piece) from the end on, of another."""
        steps: list[int] = []
        at, turns = len(self.unit), list(turns)[::-1]
        while at > 0:
            if turns and turns[-1][0] == at:
                _, begin, piece = turns.pop()
            else:
                begin, piece = at - int(self.by[at]), int(self.of[at])
            if piece >= 0:
                steps.append(piece)
            else:
                steps += self.pieces.of_unknown(self.unit[begin])[::-1]
            at = begin
        return np.array(steps[::-1], np.int32)

    def _turns(self, at: int, n: int) -> list[tuple[float, int, int, int]]:
        """The n cheapest edges (cost, end, begin, piece) into the best way from ``at`` to the
        start that it does not take itself."""
        on = np.zeros(len(self.unit) + 1, bool)
        while at > 0:
            on[at] = True
            at -= int(self.by[at])
        found: list[tuple[float, int, int, int]] = []
        for number, start in enumerate(range(0, len(self.unit), self.block)):
            sizes, ids = self.sizes[number].astype(np.int64), self.ids[number]
            begins = start + np.repeat(np.arange(len(self.counts[number])), self.counts[number])
            ends = begins + sizes
            kept = np.flatnonzero(on[ends] & (self.by[ends] != sizes))
            begins, ends, ids = begins[kept], ends[kept], ids[kept]
            costs = self.ahead[ends] - (self.ahead[begins] + self._weights(ids))
            finite = np.isfinite(costs)
            least = np.flatnonzero(finite)[np.argsort(costs[finite], kind="stable")[:n]]
            rows = (costs[least], ends[least], begins[least], ids[least])
            found += zip(*[r.tolist() for r in rows], strict=True)
            found = heapq.nsmallest(n, found)
        return found

    def others(self, n: int) -> list[tuple[float, tuple]]:
        """What the n best paths after the best one cost more, and their turns, in order.

        An open path is ranked by its score so far and the forward score of where it
        stands.  Each open path can be completed at its rank, so those behind as many
        better ones as are wanted are given up.
        """
        found: list[tuple[float, tuple]] = []
        opened: list[tuple[float, int, tuple]] = []
        pushed, cost, turns = 0, 0.0, ()
        while len(found) < n:
            at = turns[-1][1] if turns else len(self.unit)
            for more, end, begin, piece in self._turns(at, n - len(found)):
                pushed += 1
                opened.append((cost + more, pushed, (*turns, (end, begin, piece))))
            opened = heapq.nsmallest(n - len(found), opened)
            if not opened:
                break
            cost, _, turns = opened.pop(0)
            found.append((cost, turns))
        return found


def units_of(text: str) -> list[str]:
    """The units of a text, each with its space marks; together they are the marked text."""
    if "  " in text or "\x00" in text or MARK in text or text.startswith(" "):
        return _UNITS.findall(MARK + text.replace(" ", MARK))
    cut = (MARK + text.replace(" ", "\x00" + MARK).replace("\n", "\x00\n\x00")).split("\x00")
    return list(filter(None, cut)) if "\n" in text else cut


class Encoder:
    """Encodes batches of texts; what it learns about units is kept for the next batch."""

    def __init__(self, content: bytes, n: int):
        self.pieces, self.n = Pieces(content), n
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.characters = 0
        self.names: list[str] = []
        self.flat = np.zeros(0, np.int32)
        self.begins = np.zeros(1, np.int64)
        self.totals = np.zeros(0)
        self.gaps = np.zeros(0)
        self.others: dict[int, list[tuple[float, tuple[int, ...]]]] = {}

    def _learn(self, units: set[str]) -> None:
        if len(self.rows) > _UNITS_KEPT or self.characters > _CHARACTERS_KEPT:
            self.clear()
        if len(self.others) > _OTHERS_KEPT:
            self.others.clear()
        new = sorted(units.difference(self.rows), key=len)
        self.characters += sum(map(len, new))
        start = 0
        short = bisect.bisect_right(new, _LONG, key=len)
        paths: list = []
        totals, gaps = [self.totals], [self.gaps]
        while start < short:
            end = start + 1
            while end < short and (end + 1 - start) * len(new[end]) <= _CELLS:
                end += 1
            found, total, gap = best_paths(self.pieces, new[start:end])
            paths += found
            totals.append(total)
            gaps.append(gap)
            start = end
        for row, unit in enumerate(new[short:], len(self.names) + short):
            lattice = LongUnit(self.pieces, unit)
            listed = lattice.others(max(self.n - 1, 1))
            paths.append(lattice.path())
            totals.append(np.array([lattice.total]))
            gaps.append(np.array([listed[0][0] if listed else np.inf]))
            self.others[row] = [(cost, lattice.path(turns)) for cost, turns in listed]
        self.rows.update(zip(new, range(len(self.names), len(self.names) + len(new)), strict=True))
        self.names += new
        sizes = np.fromiter(map(len, paths), np.int64, len(paths))
        self.flat = np.concatenate(
            [self.flat, np.fromiter(chain.from_iterable(paths), np.int32, int(sizes.sum()))]
        )
        self.begins = np.concatenate([self.begins, self.begins[-1] + np.cumsum(sizes)])
        self.totals, self.gaps = np.concatenate(totals), np.concatenate(gaps)

    def _alternatives(self, rows: np.ndarray, first: np.ndarray, score: float) -> list[dict]:
        """The paths of a text after its best one."""
        if self.n < 2:
            return []
        gaps = self.gaps[rows]
        near = min(self.n - 1, len(gaps))
        bound = np.partition(gaps, near - 1)[near - 1]
        if len(below := np.flatnonzero(gaps < bound)) < near:
            below = np.concatenate([below, np.flatnonzero(gaps == bound)[: near - len(below)]])
        combined: list[tuple[float, tuple]] = [(0.0, ())]
        for place in sorted(below[np.isfinite(gaps[below])].tolist()):
            row = int(rows[place])
            if row not in self.others and len(self.names[row]) > _LONG:
                lattice = LongUnit(self.pieces, self.names[row])
                listed = lattice.others(self.n - 1)
                self.others[row] = [(cost, lattice.path(turns)) for cost, turns in listed]
            elif row not in self.others:
                best = tuple(self.flat[self.begins[row] : self.begins[row + 1]].tolist())
                listed = ordered_paths(self.pieces, self.names[row], self.n)
                self.others[row] = [
                    (self.totals[row] - value, ids) for value, ids in listed if ids != best
                ]
            choices = [(0.0, None), *self.others[row]]
            mixed = [
                (cost + more, changes if ids is None else (*changes, (place, ids)))
                for cost, changes in combined
                for more, ids in choices
            ]
            combined = heapq.nsmallest(self.n, mixed, key=itemgetter(0))
        return [
            {
                "score": float(score - cost),
                "changes": [
                    {
                        "first": int(first[place]),
                        "n": int(first[place + 1] - first[place]),
                        "ids": np.asarray(ids).tolist(),
                    }
                    for place, ids in changes
                ],
            }
            for cost, changes in combined[1:]
        ]

    def encode(self, texts: list[str | None]) -> list[tuple[np.ndarray, float, list[dict]]]:
        """Ids, score and other paths of each text."""
        cut = [units_of(t) if t else [] for t in texts]
        self._learn(set(chain.from_iterable(cut)))
        found = []
        for units in cut:
            if not units:
                found.append((np.zeros(0, np.int32), 0.0, []))
                continue
            rows = np.fromiter(map(self.rows.__getitem__, units), np.int64, len(units))
            sizes = self.begins[rows + 1] - self.begins[rows]
            first = np.concatenate([[0], np.cumsum(sizes)])
            at = np.repeat(self.begins[rows] - first[:-1], sizes) + np.arange(first[-1])
            score = float(self.totals[rows].sum())
            found.append((self.flat[at], score, self._alternatives(rows, first, score)))
        return found


def decoded(pieces: Pieces, ids: list[int]) -> str:
    """The text of pieces; bytes that are no UTF-8 become replacement characters."""
    text = b"".join(map(pieces.text.__getitem__, ids)).decode("utf-8", "replace")
    return text.removeprefix(" ")


_encoders: dict[tuple[bytes, int], Encoder] = {}


def _encoder(content: bytes, n: int) -> Encoder:
    hold("pieces", _encoders.clear)
    if (content, n) not in _encoders:
        _encoders.clear()
        _encoders[content, n] = Encoder(content, n)
    return _encoders[content, n]


def _encode(batches: Iterator[pa.RecordBatch], content: bytes, n: int):
    encoder = _encoder(content, n)
    change = pa.struct([("first", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int32()))])
    other = pa.list_(pa.struct([("score", pa.float64()), ("changes", pa.list_(change))]))
    for batch in batches:
        texts = batch.column(1).to_pylist()
        found = encoder.encode(texts)
        sizes = [len(ids) for ids, _, _ in found]
        offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
        flat = np.concatenate([np.zeros(0, np.int32), *[ids for ids, _, _ in found]])
        back = [
            decoded(encoder.pieces, ids.tolist()) == (text or "").replace(MARK, " ")
            for (ids, _, _), text in zip(found, texts, strict=True)
        ]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(sizes, pa.int64()),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int32())),
                pa.array([score for _, score, _ in found], pa.float64()),
                pa.array([others for _, _, others in found], other),
                pa.array(back, pa.bool_()),
            ],
            names=["doc_id", "n_pieces", "ids", "score", "alternatives", "round_trip"],
        )


def _decode(batches: Iterator[pa.RecordBatch], content: bytes):
    pieces = _encoder(content, 1).pieces
    for batch in batches:
        texts = [None if ids is None else decoded(pieces, ids) for ids in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(texts, pa.string())], names=["doc_id", "text"]
        )


def encode(
    documents: DataFrame,
    model_file: str,
    *,
    n: int = 3,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of documents with its ``n`` best segmentations.

    doc_id, n_pieces, ids and score of the best one; ``alternatives``, the next
    n - 1 in order, each with its score and its changes to the best one: ``n`` pieces
    from position ``first`` are replaced by ``ids``.  A unit of one possible path
    has none, so there can be fewer.  ``round_trip`` says that the ids decode to the
    text; a space mark in a text decodes to a space, as sentencepiece has it.  Among
    paths of equal score any may come first, the same one each time.

    A text without spaces may be of any length: 2 million characters take some 150 MB and
    6 seconds.  A null or empty text has no pieces and score 0.  A null id stays null,
    repeated rows come back each, an empty table gives an empty result, and other
    columns are not looked at.
    """
    ready(documents.sparkSession)
    content = Path(model_file).read_bytes()
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )
    return texts.mapInArrow(lambda batches: _encode(batches, content, n), _ENCODED)


def decode(
    encoded: DataFrame, model_file: str, *, id_column: str = "doc_id", ids_column: str = "ids"
) -> DataFrame:
    """doc_id and text of every row of ids; null ids give a null text."""
    ready(encoded.sparkSession)
    content = Path(model_file).read_bytes()
    ids = encoded.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(ids_column).cast("array<int>").alias("ids"),
    )
    return ids.mapInArrow(lambda batches: _decode(batches, content), "doc_id long, text string")
