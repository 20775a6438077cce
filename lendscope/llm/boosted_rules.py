"""Quality rules: fixed limits, then boosted trees over document statistics.

The trees are grown on a bounded sample of labelled rows, by gradients of the
logistic loss over quantile bins.  Statistics that only junk raises may never
raise a score, whatever the labels say (monotonic constraints).  Trees of one depth
lie in flat arrays, so a batch of texts is scored level by level without a loop
over texts.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lendscope.llm.common import ready
from lendscope.llm.text_statistics import (
    COUNTS,
    RATIOS,
    count_all,
    labelled_sample,
    statistics,
)

#: Labelled rows to learn from, about.
TRAINING_ROWS = 4000
INPUTS = (*[name for name, _, _ in RATIOS], "n_words")
#: -1: a higher value never gives a higher score.
CONSTRAINTS = {
    "symbol_share": -1,
    "symbols_a_word": -1,
    "dup_line_share": -1,
    "repeat_share": -1,
    "distinct_share": 1,
}
LEAST_WORDS = 50
MOST_REPEATED = 50  # of 100 words
KEPT_FROM = 0.3


@dataclass(frozen=True)
class Trees:
    """Full binary trees of one depth: (tree, inner node) splits and (tree, leaf) values.

    The children of node i are 2i + 1, for values up to the bound, and 2i + 2.
    """

    inputs: np.ndarray
    bounds: np.ndarray
    leaves: np.ndarray
    start: float

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Probability of label 1 for rows of INPUTS."""
        total = np.full(len(rows), self.start)
        line = np.arange(len(rows))
        inner = self.inputs.shape[1]
        for inputs, bounds, leaves in zip(self.inputs, self.bounds, self.leaves, strict=True):
            node = np.zeros(len(rows), np.int64)
            while inner and node[0:1].size and node[0] < inner:
                node = 2 * node + 1 + (rows[line, inputs[node]] > bounds[node])
            total += leaves[node - inner]
        return 1 / (1 + np.exp(-total))


def _grown(bins, slope, bend, edges, signs, depth: int, least: float):
    """One tree on binned rows: inputs, bounds, leaf values, and each row's leaf."""
    inner = 2**depth - 1
    inputs, bounds = np.zeros(inner, np.int64), np.full(inner, np.inf)
    low, high = np.full(2 * inner + 1, -np.inf), np.full(2 * inner + 1, np.inf)
    node = np.zeros(len(bins), np.int64)
    width = max(len(e) for e in edges) + 1
    for at in range(inner):
        mine = np.flatnonzero(node == at)
        best = (1e-6, None)
        if len(mine):
            whole_slope, whole_bend = slope[mine].sum(), bend[mine].sum()
            for f, cuts in enumerate(edges):
                if not len(cuts):
                    continue
                s = np.cumsum(np.bincount(bins[mine, f], slope[mine], width))[: len(cuts)]
                b = np.cumsum(np.bincount(bins[mine, f], bend[mine], width))[: len(cuts)]
                left = np.clip(-s / (b + 1), low[at], high[at])
                right = np.clip(-(whole_slope - s) / (whole_bend - b + 1), low[at], high[at])
                gain = s**2 / (b + 1) + (whole_slope - s) ** 2 / (whole_bend - b + 1)
                gain -= whole_slope**2 / (whole_bend + 1)
                fits = (b >= least) & (whole_bend - b >= least) & (signs[f] * (right - left) >= 0)
                gain = np.where(fits, gain, 0)
                k = int(gain.argmax())
                if gain[k] > best[0]:
                    best = (gain[k], (f, k, left[k], right[k]))
        below = (2 * at + 1, 2 * at + 2)
        for child in below:
            low[child], high[child] = low[at], high[at]
        if best[1] is None:
            node[mine] = below[0]
            continue
        f, k, left, right = best[1]
        inputs[at], bounds[at] = f, edges[f][k]
        node[mine] = np.where(bins[mine, f] <= k, below[0], below[1])
        if signs[f]:
            # All leaves on one side stay on their side of the middle.
            middle = (left + right) / 2
            smaller, larger = below if signs[f] > 0 else below[::-1]
            high[smaller], low[larger] = middle, middle
    leaf = node - inner
    s, b = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
    return inputs, bounds, np.clip(-s / (b + 1), low[inner:], high[inner:]), leaf


def fit(
    rows: np.ndarray,
    labels: np.ndarray,
    *,
    constraints: Mapping[str, int] | None = None,
    trees: int = 60,
    depth: int = 3,
    rate: float = 0.2,
    bins: int = 64,
) -> Trees:
    """Grow trees on rows of INPUTS; without rows, or with one label, there is no split."""
    constraints = CONSTRAINTS if constraints is None else constraints
    inner = 2**depth - 1
    share = (labels.sum() + 0.5) / (len(labels) + 1)
    start = float(np.log(share / (1 - share)))
    if not len(rows) or labels.min() == labels.max():
        none = np.zeros((0, inner), np.int64)
        return Trees(none, none.astype(float), np.zeros((0, inner + 1)), start)
    # Cuts lie between values, so that rounding moves no row across one.
    edges = []
    for f in range(rows.shape[1]):
        values = np.unique(np.quantile(rows[:, f], np.linspace(0, 1, bins), method="nearest"))
        edges.append((values[:-1] + values[1:]) / 2)
    binned = np.stack([np.searchsorted(e, rows[:, f], "left") for f, e in enumerate(edges)], 1)
    signs = [constraints.get(name, 0) for name in INPUTS]
    total = np.full(len(rows), start)
    grown = []
    for _ in range(trees):
        chance = 1 / (1 + np.exp(-total))
        inputs, bounds, leaves, leaf = _grown(
            binned, chance - labels, chance * (1 - chance), edges, signs, depth, 1.0
        )
        grown.append((inputs, bounds, rate * leaves))
        total += rate * leaves[leaf]
    return Trees(*[np.stack(part) for part in zip(*grown, strict=True)], start)


def inputs_of(counts: Mapping[str, np.ndarray]) -> np.ndarray:
    """Rows of INPUTS from counts; a share of nothing is 0."""
    columns = [
        counts[above] / np.maximum(counts[below], 1) * (counts[below] > 0)
        for _, above, below in RATIOS
    ]
    return np.stack([*columns, counts["n_words"].astype(float)], 1)


def learn(
    documents: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    keep: Column | None = None,
    bound: int = TRAINING_ROWS,
) -> Trees:
    """Fit on about ``bound`` labelled documents, whose counts the driver takes."""
    sample = labelled_sample(documents, labels, label, bound, keep)
    known = sample.select("doc_id", "label").dropDuplicates(["doc_id"])
    taken = statistics(sample).dropDuplicates().join(known, "doc_id").toPandas()
    taken = taken.sort_values(["doc_id", *COUNTS])
    counts = {c: taken[c].to_numpy(np.int64) for c in COUNTS}
    return fit(inputs_of(counts), taken["label"].to_numpy(float))


def _judged(batches: Iterator[pa.RecordBatch], trees: Trees):
    shown = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    for batch in batches:
        counts = count_all(batch.column(1).to_pylist())
        scores = trees.score(inputs_of(counts))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), *[pa.array(counts[c]) for c in shown], pa.array(scores)],
            names=["doc_id", *shown, "score"],
        )


def judge(
    documents: DataFrame,
    trees: Trees,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    threshold: float = KEPT_FROM,
) -> DataFrame:
    """One row per row of documents: doc_id, counts, base_failed, kept, score.

    n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words are counted over
    the whole text.  ``base_failed`` texts, of under 50 words or with more than half
    of them in repeated windows of three, are not kept; of the others those are
    that score ``threshold`` or more.  A null text has no words, a null id stays
    null, repeated rows come back each, an empty table gives an empty result, and
    other columns are not looked at.
    """
    ready(documents.sparkSession)
    texts = documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
    )
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words")
    )
    return (
        texts.mapInArrow(
            lambda batches: _judged(batches, trees),
            "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
            "n_repeat_words long, score double",
        )
        .withColumn("base_failed", failed)
        .withColumn("kept", ~failed & (F.col("score") >= threshold))
    )
