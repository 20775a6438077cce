"""Language of every word of code-switched text by a linear-chain conditional random field.

A word's scores come from its affixes, its character n-grams and the word itself
as a lexicon entry, all hashed into weight tables; learned transition scores tie
neighbouring words together; forward-backward gives each word's probabilities.
Training sequences are spliced from stretches of documents of different languages,
so switches are seen.  A document's language is that of the largest share of
probability over its words with letters.

In a batch all words of all documents form one chain that forgets itself where a
document begins.  The chain is cut into blocks whose transfer matrices are built
side by side, so that long documents cost no more steps than short ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import hold, with_row, with_texts

#: Labelled documents of each language to learn from, about.
TRAINING_DOCUMENTS = 400
#: Training sequences for each of these documents.
SEQUENCES_A_DOCUMENT = 6
#: Languages in the labels; more are an error.
MOST_LANGUAGES = 250
UNKNOWN = "und"
_TABLE_BITS = 15
_BLOCK = 256
_WORDS_KEPT = 250_000
_LONGEST = 128
_DRAW = 1 << 20
#: Words of one language in a row in a training sequence, but where it is cut off.
_LEAST_STRETCH = 6

# (first character, characters) counted from the start, or from the end where negative.
_AFFIXES = ((0, 1), (0, 2), (0, 3), (-1, 1), (-2, 2), (-3, 3), (-4, 4))
_GRAMS = (1, 2, 3)
_TABLES = len(_AFFIXES) + len(_GRAMS) + 1
_MIX = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Model:
    """Weight tables (table, bucket, language), transition scores, language names."""

    weights: np.ndarray
    transitions: np.ndarray
    languages: tuple[str, ...]
    #: Per row of the flattened tables, whether two or more texts learned from have it.
    known: np.ndarray | None = None


def letters_of(token: str) -> str:
    """The letters of a token, lower-cased."""
    return (token if token.isalpha() else "".join(filter(str.isalpha, token))).lower()


def _parts(word: str) -> list[str]:
    """A word in parts of bounded length; in scripts without spaces a word is a sentence."""
    return [word[k : k + _LONGEST] for k in range(0, len(word), _LONGEST)]


def _buckets(hashes: np.ndarray, number: int) -> np.ndarray:
    mixed = (hashes + np.uint64(number + 1)) * _MIX
    return ((mixed ^ (mixed >> np.uint64(31))) * _MIX >> np.uint64(64 - _TABLE_BITS)).astype(
        np.int64
    ) + (number << _TABLE_BITS)


def _features(words: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """Rows into the flattened tables for each word, and which of them count.

    The words have one letter at least; the matrix is as wide as the longest.
    """
    width = max(map(len, words))
    codes = np.array(words, dtype=f"U{width}").view(np.uint32).reshape(len(words), width)
    codes = codes.astype(np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    rows, used = [], []

    def add(hashes: np.ndarray, mask: np.ndarray) -> None:
        rows.append(_buckets(hashes, number))
        used.append(mask)

    number = 0
    line = np.arange(len(words))
    for begin, size in _AFFIXES:
        hashes = np.zeros(len(words), np.uint64)
        for k in range(size):
            at = begin + k if begin >= 0 else np.maximum(lengths + begin + k, 0)
            at = np.minimum(at, width - 1)
            hashes = hashes * np.uint64(1_000_003) + codes[line, at]
        add(hashes[:, None], (lengths >= size)[:, None])
        number += 1
    place = np.arange(width)
    for size in _GRAMS:
        if width >= size:
            hashes = np.zeros((len(words), width - size + 1), np.uint64)
            for k in range(size):
                hashes = hashes * np.uint64(1_000_003) + codes[:, k : width - size + 1 + k]
            add(hashes, place[None, : width - size + 1] <= (lengths - size)[:, None])
        number += 1
    hashes = np.zeros(len(words), np.uint64)
    for k in range(width):
        hashes = np.where(k < lengths, hashes * np.uint64(1_000_003) + codes[:, k], hashes)
    add(hashes[:, None], np.ones((len(words), 1), bool))
    return np.concatenate(rows, 1), np.concatenate(used, 1)


def word_scores(weights: np.ndarray, words: Sequence[str]) -> np.ndarray:
    """Scores (word, language); features of a word count by their mean over the word."""
    flat = weights.reshape(-1, weights.shape[-1])
    found = np.zeros((len(words), flat.shape[1]), np.float32)
    # Words of like length go together; very long ones by the sum over their parts.
    order = sorted(range(len(words)), key=lambda i: len(words[i]))
    for start in range(0, len(order), 4096):
        mine = order[start : start + 4096]
        parts = [(i, part) for i in mine for part in _parts(words[i])]
        rows, used = _features([p for _, p in parts])
        sums = np.einsum("wfl,wf->wl", flat[rows], used.astype(np.float32))
        np.add.at(found, [i for i, _ in parts], sums)
    return found


def marginals(scores: np.ndarray, starts: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Probabilities (word, language) by forward-backward; ``starts`` marks first words."""
    count, size = scores.shape
    if not count:
        return np.zeros((0, size))
    blocks = -(-count // _BLOCK)
    emitted = np.ones((blocks * _BLOCK, size))
    emitted[:count] = np.exp(scores - scores.max(1, keepdims=True))
    first = np.ones(blocks * _BLOCK, bool)
    first[:count] = starts
    emitted = emitted.reshape(blocks, _BLOCK, size).transpose(1, 0, 2).copy()
    first = first.reshape(blocks, _BLOCK).T.copy()
    step = np.exp(transitions - transitions.max())
    transfer = np.broadcast_to(np.eye(size), (blocks, size, size)).copy()
    for s in range(_BLOCK):
        moved = transfer @ step
        if first[s].any():
            moved = np.where(first[s][:, None, None], transfer.sum(2, keepdims=True), moved)
        transfer = moved * emitted[s][:, None, :]
        transfer /= transfer.sum((1, 2), keepdims=True)
    into = np.empty((blocks, size))
    out = np.empty((blocks, size))
    state = np.full(size, 1 / size)
    for k in range(blocks):
        into[k] = state
        state = state @ transfer[k]
        state /= state.sum()
    state = np.ones(size)
    for k in range(blocks - 1, -1, -1):
        out[k] = state
        state = transfer[k] @ state
        state /= state.sum()
    forward = np.empty_like(emitted)
    state = into
    for s in range(_BLOCK):
        moved = np.where(first[s][:, None], state.sum(1, keepdims=True), state @ step)
        state = moved * emitted[s]
        state /= state.sum(1, keepdims=True)
        forward[s] = state
    state = out
    for s in range(_BLOCK - 1, -1, -1):
        forward[s] *= state
        seen = state * emitted[s]
        state = np.where(first[s][:, None], seen.sum(1, keepdims=True), seen @ step.T)
        state /= state.sum(1, keepdims=True)
    found = forward.transpose(1, 0, 2).reshape(-1, size)[:count]
    return found / found.sum(1, keepdims=True)


def _known_features(documents: Sequence[Sequence[str]]) -> np.ndarray:
    """Per row of the flattened tables, whether words of two or more different texts have it."""
    texts = list(dict.fromkeys(map(tuple, documents)))
    holder: dict[str, int] = {}
    for i, words in enumerate(texts):
        for word in set(words):
            holder[word] = i if holder.get(word, i) == i else -1
    # A word of several texts counts for two that no other word is of.
    counts = np.zeros(_TABLES << _TABLE_BITS, np.int64)
    pairs = []
    words = sorted(holder, key=len)
    for start in range(0, len(words), 4096):
        mine = words[start : start + 4096]
        rows, used = _features(mine)
        of = np.broadcast_to(np.array([holder[w] for w in mine])[:, None], rows.shape)
        counts[rows[used & (of < 0)]] = 2
        once = used & (of >= 0)
        pairs.append(np.unique(rows[once] * len(texts) + of[once]))
    if pairs:
        counts += np.bincount(np.unique(np.concatenate(pairs)) // len(texts), minlength=len(counts))
    return counts >= 2


def sequences_of(documents: int) -> int:
    """Training sequences for so many documents."""
    return SEQUENCES_A_DOCUMENT * documents


def fit(
    texts: Sequence[str],
    languages: Sequence[str],
    *,
    passes: int = 3,
    length: int = 48,
    seed: int = 11,
    evidence: bool = False,
) -> Model:
    """Learn from texts with one language each; ``evidence`` keeps which features are known."""
    names = tuple(sorted(set(languages)))
    number = {name: i for i, name in enumerate(names)}
    drawn = np.random.default_rng(seed)
    documents = [
        (number[name], words)
        for text, name in zip(texts, languages, strict=True)
        if (words := [p for w in map(letters_of, text.split()) for p in _parts(w)])
    ]
    own: dict[int, list[list[str]]] = {}
    for label, words in documents:
        own.setdefault(label, []).append(words)
    known = _known_features([words for _, words in documents]) if evidence else None
    weights = np.zeros((_TABLES << _TABLE_BITS, len(names)), np.float32)
    squares = np.full(weights.shape, 1e-2, np.float32)
    transitions = np.zeros((len(names), len(names)))
    slopes = np.full(transitions.shape, 1e-2)
    if not documents or len(names) < 2:
        return Model(weights.reshape(_TABLES, -1, len(names)), transitions, names, known)
    pool: dict[str, int] = {}

    def stretch() -> tuple[list[int], list[int]]:
        """One training sequence: stretches of documents, of one language as often as not."""
        words: list[int] = []
        labels: list[int] = []
        while len(words) < length:
            label, all_words = documents[drawn.integers(len(documents))]
            size = int(drawn.integers(_LEAST_STRETCH, length + 1))
            at = int(drawn.integers(max(1, len(all_words) - size + 1)))
            taken = all_words[at : at + size]
            # Short documents are followed by others of their language.
            while len(taken) < _LEAST_STRETCH:
                taken = taken + own[label][drawn.integers(len(own[label]))][: size - len(taken)]
            words += [pool.setdefault(w, len(pool)) for w in taken]
            labels += [label] * (len(words) - len(labels))
        return words[:length], labels[:length]

    made = sequences_of(len(documents))
    sequence = np.empty((made, length), np.int32)
    truth = np.empty((made, length), np.int32)
    for k in range(made):
        sequence[k], truth[k] = stretch()
    vocabulary = list(pool)
    rows = np.zeros((0, 0))
    for _ in range(passes):
        order = drawn.permutation(made)
        for start in range(0, len(order), 64):
            ids, gold = sequence[order[start : start + 64]], truth[order[start : start + 64]]
            distinct, inverse = np.unique(ids, return_inverse=True)
            rows, used = _features([vocabulary[i] for i in distinct])
            mask = used.astype(np.float32)
            scores = np.einsum("wfl,wf->wl", weights[rows], mask)[inverse.reshape(ids.shape)]
            # Forward and backward over sequences of one length, all at once.
            emitted = np.exp(scores - scores.max(2, keepdims=True)).astype(float)
            step = np.exp(transitions)
            ahead = np.empty_like(emitted)
            back = np.ones_like(emitted)
            ahead[:, 0] = emitted[:, 0] / emitted[:, 0].sum(1, keepdims=True)
            for t in range(1, length):
                ahead[:, t] = (ahead[:, t - 1] @ step) * emitted[:, t]
                ahead[:, t] /= ahead[:, t].sum(1, keepdims=True)
            for t in range(length - 2, -1, -1):
                back[:, t] = (back[:, t + 1] * emitted[:, t + 1]) @ step.T
                back[:, t] /= back[:, t].sum(1, keepdims=True)
            each = ahead * back
            each /= each.sum(2, keepdims=True)
            # Expected pairs, summed without a table of pairs for each place.
            before, after = ahead[:, :-1], emitted[:, 1:] * back[:, 1:]
            before = before / ((before @ step) * after).sum(2, keepdims=True)
            pairs = step * (before.reshape(-1, len(names)).T @ after.reshape(-1, len(names)))
            wanted = np.zeros_like(transitions)
            np.add.at(wanted, (gold[:, :-1].ravel(), gold[:, 1:].ravel()), 1)
            slope = (pairs - wanted) / len(ids) + 1e-3 * transitions
            slopes += slope**2
            transitions = transitions - 0.2 * slope / np.sqrt(slopes)
            error = each
            error[np.arange(len(ids))[:, None], np.arange(length), gold] -= 1
            by_word = np.zeros((len(distinct), len(names)))
            np.add.at(by_word, inverse.ravel(), error.reshape(-1, len(names)))
            flat = rows[used]
            values = np.repeat(by_word / len(ids), used.sum(1), axis=0)
            touched, position = np.unique(flat, return_inverse=True)
            slope = np.stack(
                [np.bincount(position, values[:, k], len(touched)) for k in range(len(names))], 1
            ).astype(np.float32)
            slope += 1e-5 * weights[touched]
            squares[touched] += slope**2
            weights[touched] -= 0.1 * slope / np.sqrt(squares[touched])
    return Model(weights.reshape(_TABLES, -1, len(names)), transitions, names, known)


def learn(
    documents: DataFrame,
    *,
    keep: Column | None = None,
    per_language: int = TRAINING_DOCUMENTS,
    id_column: str = "doc_id",
    text_column: str = "text",
    language_column: str = "lang",
    evidence: bool = False,
) -> Model | None:
    """Fit on about ``per_language`` documents of each language, drawn by a hash of the id.

    ``keep`` says which rows may be learned from.  Rows without text or language
    are left out; without any row there is no model.
    """
    rows = documents.where(F.col(text_column).isNotNull() & F.col(language_column).isNotNull())
    if keep is not None:
        rows = rows.where(keep)
    counts = rows.groupBy(F.col(language_column).alias("language")).count().limit(MOST_LANGUAGES + 1)
    sizes = {r["language"]: r["count"] for r in counts.collect()}
    if not sizes:
        return None
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    draw = F.pmod(F.xxhash64(F.col(id_column).cast("string"), F.lit("sample")), F.lit(_DRAW))
    share = F.lit(0)
    for name, size in sizes.items():
        bound = -(-_DRAW * per_language // size)
        share = F.when(F.col(language_column) == name, bound).otherwise(share)
    sample = (
        rows.where(draw < share)
        .select(
            F.col(language_column).cast("string").alias("language"),
            F.col(text_column).cast("string").alias("text"),
            F.xxhash64(F.col(id_column).cast("string"), text_column).alias("order"),
        )
        .orderBy("order", "language", "text")
        .limit(2 * per_language * len(sizes))
        .collect()
    )
    if not sample:
        return None
    return fit([r["text"] for r in sample], [r["language"] for r in sample], evidence=evidence)


class _Scores:
    """Scores of tokens, computed once a batch for new ones and kept for the next."""

    def __init__(self, model: Model):
        self.model = model
        # Behind the languages: known features, and all of them, added up in the same way.
        flat = model.weights.reshape(-1, model.weights.shape[-1])
        known = np.zeros(len(flat), bool) if model.known is None else model.known
        self.weights = np.concatenate(
            [flat, known[:, None], np.ones((len(flat), 1))], 1, dtype=np.float32
        )
        self.clear()

    def clear(self) -> None:
        self.rows: dict[str, int] = {}
        self.table = np.zeros((0, len(self.model.languages) + 2), np.float32)
        self.lettered = np.zeros(0, np.int64)

    def of(self, tokens: list[list[str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Scores of all tokens one after the other, how many parts with letters each has,
        and the share of its features that are known."""
        if len(self.rows) > _WORDS_KEPT:
            self.clear()
        new = [t for t in set(chain.from_iterable(tokens)).difference(self.rows)]
        words = list(map(letters_of, new))
        with_letters = [i for i, w in enumerate(words) if w]
        scores = np.zeros((len(new), self.table.shape[1]), np.float32)
        if with_letters:
            scores[with_letters] = word_scores(self.weights, [words[i] for i in with_letters])
        lettered = np.array([-(-len(w) // _LONGEST) for w in words], np.int64)
        self.rows.update(zip(new, range(len(self.table), len(self.table) + len(new)), strict=True))
        self.table = np.concatenate([self.table, scores])
        self.lettered = np.concatenate([self.lettered, lettered])
        count = sum(map(len, tokens))
        at = np.fromiter(map(self.rows.__getitem__, chain.from_iterable(tokens)), np.int64, count)
        found = self.table[at]
        return found[:, :-2], self.lettered[at], found[:, -2] / np.maximum(found[:, -1], 1)


_kept: list[tuple[bytes, _Scores]] = []


def _scores(model: Model) -> _Scores:
    hold("languages", _kept.clear)
    known = b"" if model.known is None else model.known.tobytes()[:: 1 << 6]
    key = model.weights.tobytes()[:: 1 << 10] + repr(model.languages).encode() + known
    if not _kept or _kept[0][0] != key:
        _kept[:] = [(key, _Scores(model))]
    return _kept[0][1]


def _tagged(texts: list[str | None], scores: _Scores):
    """Probabilities of all words, their parts with letters, where each text begins, and the
    share of each word's features that are known."""
    tokens = [t.split() if t else [] for t in texts]
    begins = np.concatenate([[0], np.cumsum([len(t) for t in tokens])]).astype(np.int64)
    emitted, lettered, known = scores.of(tokens)
    starts = np.zeros(len(emitted), bool)
    starts[begins[:-1][begins[:-1] < len(emitted)]] = True
    return marginals(emitted, starts, scores.model.transitions), lettered, begins, known


def _predicted(batches: Iterator[pa.RecordBatch], model: Model, sure: bool):
    scores = _scores(model)
    for batch in batches:
        found, lettered, begins, known = _tagged(batch.column(1).to_pylist(), scores)
        # The last columns are each word's largest probability and its known share.
        found = np.concatenate(
            [found, found.max(1, initial=0.0, keepdims=True), known[:, None]], 1
        )
        sums = np.concatenate([np.zeros((1, found.shape[1])), np.cumsum(found * lettered[:, None], 0)])
        mass = sums[begins[1:]] - sums[begins[:-1]]
        mass, largest, known = mass[:, :-2], mass[:, -2], mass[:, -1]
        total = mass.sum(1)
        best = mass.argmax(1)
        some = total > 1e-6
        share = np.where(some, mass[np.arange(len(mass)), best] / np.where(some, total, 1), 0.0)
        names = [model.languages[b] if s else UNKNOWN for b, s in zip(best, some, strict=True)]
        surest = np.where(some, largest / np.where(some, total, 1), 0.0)
        backed = np.where(some, known / np.where(some, total, 1), 0.0)
        words = [pa.array(np.clip(x, 0, 1)) for x in (surest, backed)] if sure else []
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(names, pa.string()), pa.array(np.clip(share, 0, 1)),
             *words, *batch.columns[2:]],
            names=["doc_id", "lang_pred", "score", *["word_score", "known_share"] * sure,
                   *batch.schema.names[2:]],
        )


def _spans(batches: Iterator[pa.RecordBatch], model: Model):
    scores = _scores(model)
    for batch in batches:
        found, _, begins, _ = _tagged(batch.column(1).to_pylist(), scores)
        best = found.argmax(1)
        spans = []
        for begin, end in zip(begins[:-1], begins[1:], strict=True):
            mine = best[begin:end]
            cuts = np.flatnonzero(np.diff(mine)) + 1
            edges = [0, *cuts.tolist(), len(mine)] if len(mine) else [0]
            spans.append(
                [
                    {"first_word": a, "n_words": b - a, "lang": model.languages[mine[a]]}
                    for a, b in zip(edges[:-1], edges[1:], strict=True)
                ]
            )
        kind = pa.list_(
            pa.struct([("first_word", pa.int64()), ("n_words", pa.int64()), ("lang", pa.string())])
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(spans, kind)], names=["doc_id", "spans"]
        )


def identify(
    documents: DataFrame,
    model: Model | None,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    carry: bool = False,
    sure: bool = False,
) -> DataFrame:
    """One row per row of documents: doc_id, lang_pred, score; the whole row where carried.

    ``score`` is the language's share of probability over the words with letters, where
    one of more than 128 letters counts once for each 128 begun, as in training.
    ``sure`` adds ``word_score``, the mean over these words of the largest probability
    of each: a text in several languages has a high one where its words are clear.  It
    also adds ``known_share``, the mean share of their features that two or more texts
    of the sample have (0 for a model without evidence): what is in no learned language
    has a low one, however sure the model is of it, and one text cannot vouch for itself.
    A null text and one without letters is ``und`` with score 0, and so is every
    text without a model.  Ties go to the first language by name.  A null id stays
    null, repeated rows come back each, an empty table gives an empty result, and
    other columns are not looked at.
    """
    texts = with_texts(documents, id_column, text_column, carry)
    if model is None:
        return texts.select(
            "doc_id",
            F.lit(UNKNOWN).alias("lang_pred"),
            F.lit(0.0).alias("score"),
            *[F.lit(0.0).alias(c) for c in ("word_score", "known_share")][: 2 * sure],
            *["row"] * carry,
        )
    words = ", word_score double, known_share double" * sure
    return texts.mapInArrow(
        lambda batches: _predicted(batches, model, sure),
        with_row(f"doc_id long, lang_pred string, score double{words}", documents, carry),
    )


def label_words(
    documents: DataFrame,
    model: Model,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
) -> DataFrame:
    """One row per row of documents: doc_id and spans of words in one language.

    Words are counted from 0 between white space; a null or empty text has no span.
    """
    return with_texts(documents, id_column, text_column).mapInArrow(
        lambda batches: _spans(batches, model),
        "doc_id long, spans array<struct<first_word: long, n_words: long, lang: string>>",
    )
