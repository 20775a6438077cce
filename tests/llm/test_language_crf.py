"""Words and documents of known languages; forward-backward against all label sequences."""

from __future__ import annotations

import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.llm import language_crf as crf
from lendscope.llm.common import fold


def by_all_sequences(scores, transitions):
    count, size = scores.shape
    total = np.zeros((count, size))
    for labels in itertools.product(range(size), repeat=count):
        weight = sum(scores[i, k] for i, k in enumerate(labels))
        weight += sum(transitions[a, b] for a, b in itertools.pairwise(labels))
        for i, k in enumerate(labels):
            total[i, k] += np.exp(weight)
    return total / total.sum(1, keepdims=True)


def test_marginals_equal_sums_over_all_sequences():
    drawn = np.random.default_rng(1)
    transitions = drawn.normal(size=(3, 3))
    parts = [drawn.normal(size=(n, 3)) for n in (4, 1, 6, 2)]
    starts = np.zeros(13, bool)
    starts[[0, 4, 5, 11]] = True
    found = crf.marginals(np.concatenate(parts), starts, transitions)
    expected = np.concatenate([by_all_sequences(p, transitions) for p in parts])
    assert found == pytest.approx(expected)


def test_blocks_do_not_matter(monkeypatch):
    drawn = np.random.default_rng(2)
    scores, transitions = drawn.normal(size=(1000, 4)) * 3, drawn.normal(size=(4, 4))
    starts = drawn.random(1000) < 0.02
    starts[0] = True
    one = crf.marginals(scores, starts, transitions)
    monkeypatch.setattr(crf, "_BLOCK", 7)
    assert crf.marginals(scores, starts, transitions) == pytest.approx(one)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return crf.learn(documents, keep=fold("doc_id", 3) != 1, per_language=150)


def test_held_out_documents(documents, model):
    found = crf.identify(documents, model).join(documents.select("doc_id", "lang"), "doc_id")
    held_out = found.where(fold("doc_id", 3) == 1)
    right = held_out.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).head()[0]
    assert right > 0.97


def test_words_of_mixed_text_are_labelled(spark, documents, model):
    rows = documents.where("n_chars > 600").where("lang in ('en', 'de')").limit(400).collect()
    drawn = random.Random(4)
    of = {k: [r["text"].split()[:60] for r in rows if r["lang"] == k] for k in ("en", "de")}
    mixed, truth = [], []
    for i in range(20):
        a, b = drawn.choice(of["en"]), drawn.choice(of["de"])
        mixed.append((i, " ".join(a + b)))
        truth.append(["en"] * len(a) + ["de"] * len(b))
    docs = spark.createDataFrame(mixed, "doc_id long, text string")
    right = total = 0
    for row in crf.label_words(docs, model).collect():
        labels = [s["lang"] for s in row["spans"] for _ in range(s["n_words"])]
        assert [s["first_word"] for s in row["spans"]][0] == 0
        right += sum(a == b for a, b in zip(labels, truth[row["doc_id"]], strict=True))
        total += len(labels)
    assert right / total > 0.9


def test_odd_rows(spark, model):
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 ... !!", None), (None, "the of and", "x"),
            (4, "the " * 30_000, None), (4, "the " * 30_000, None), (5, "x" * 5000, "q")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    found = crf.identify(docs, model).collect()
    assert len(found) == len(rows)
    by_id = {r["doc_id"]: r for r in found}
    assert [by_id[i]["lang_pred"] for i in (1, 2, 3)] == ["und"] * 3
    assert [by_id[i]["score"] for i in (1, 2, 3)] == [0.0] * 3
    assert by_id[4]["lang_pred"] == "en" and all(0 <= r["score"] <= 1 for r in found)
    assert crf.identify(docs.limit(0), model).count() == 0
    carried = crf.identify(docs, model, carry=True).select("row.*")
    assert carried.columns == docs.columns and carried.count() == len(rows)
    assert crf.label_words(docs.where("doc_id = 1"), model).head()["spans"] == []


def test_without_labels_there_is_no_model(spark):
    docs = spark.createDataFrame([(1, "a", None)], "doc_id long, text string, lang string")
    assert crf.learn(docs) is None
    assert crf.identify(docs, None).head()["lang_pred"] == "und"
    one = spark.createDataFrame([(1, "a b c d e", "en")], "doc_id long, text string, lang string")
    assert crf.identify(one, crf.learn(one)).head()["lang_pred"] == "en"


def test_languages_of_few_long_words_are_learned(spark):
    drawn = np.random.default_rng(3)

    def paragraph(first, many):
        return "".join(chr(first + int(k)) for k in drawn.integers(0, 60, many))

    texts = [f"{paragraph(0x4E00, 200)}。" for _ in range(40)]
    # Katakana come late in a paragraph only.
    texts += [paragraph(0x3041, 130) + paragraph(0x30A1, 130) for _ in range(40)]
    texts += [" ".join(drawn.choice(["the", "house", "is", "old", "and", "tall"], 20)) for _ in range(40)]
    model = crf.fit(texts, ["zh"] * 40 + ["ja"] * 40 + ["en"] * 40)
    rows = [
        (1, paragraph(0x4E00, 90)), (2, paragraph(0x30A1, 90)), (3, "the old house"),
        (4, f"the old house {paragraph(0x4E00, 900)}"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r["lang_pred"] for r in crf.identify(docs, model).collect()}
    assert found == {1: "zh", 2: "ja", 3: "en", 4: "zh"}


def test_training_grows_with_the_sample():
    assert [crf.sequences_of(n) for n in (1, 1_600, 100_000)] == [6, 9_600, 600_000]
