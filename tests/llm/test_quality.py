"""Counts against plain Python, rules and trees against held-out labels and their own promises."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from lendscope.llm import boosted_rules, queries, rule_quality
from lendscope.llm.common import fold
from lendscope.llm.text_statistics import count_all

TABLES = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_chars": len(text),
        "word_chars": sum(map(len, words)),
        "n_words": len(words),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_distinct_words": len(set(words)),
        "n_repeat_words": len(covered),
    }


def test_counts_equal_plain_python():
    drawn = random.Random(1)
    parts = ["a", "b", "é日", " ", "\n", "\t", "\x0b", "\x1c", "#", "<>", " ", "\r\n", "a b a "]
    made = ["".join(drawn.choice(parts) for _ in range(drawn.randint(0, 60))) for _ in range(400)]
    made += [None, "", "a a a", "a a a a", "x y z x y z"]
    found = count_all(made)
    for k, text in enumerate(made):
        expected = plain(text)
        assert {name: int(found[name][k]) for name in expected} == expected


@pytest.fixture(scope="module")
def scored(spark):
    return queries.quality(spark, TABLES).persist()


def test_rules_tell_held_out_labels(spark, scored):
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    rows = scored.where("held_out").join(labels, "doc_id").collect()
    right = np.mean([r["predicted"] == r["quality"] for r in rows])
    assert len(rows) > 40 and right > 0.95


def test_a_score_only_depends_on_the_text(spark, scored):
    documents = spark.read.parquet(f"{TABLES}/documents.parquet").select("doc_id", "text")
    both = scored.join(documents, "doc_id").groupBy("text").agg(F.countDistinct("score").alias("n"))
    assert both.where("n > 1").count() == 0


def test_rules_without_labels(spark):
    docs = spark.createDataFrame([(1, "a"), (None, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, quality int")
    model = rule_quality.learn(docs, labels)
    assert {r["score"] for r in rule_quality.score_quality(docs, model).collect()} == {0.5}
    one = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    model = rule_quality.learn(docs, one)
    assert rule_quality.score_quality(docs, model).where("predicted = 1").count() == 2


def odd_documents(spark):
    rows = [(1, None, 1.5), (2, "", None), (None, "x y", 1.0), (3, "w " * 40_000, 1.0), (3, "w " * 40_000, 1.0)]
    return spark.createDataFrame(rows, "doc_id long, text string, score double")


def test_rules_on_odd_rows(spark, scored):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    model = rule_quality.learn(docs, labels, keep=fold("doc_id", 5) != 0)
    found = rule_quality.score_quality(odd_documents(spark), model).collect()
    assert len(found) == 5 and all(0 <= r["score"] <= 1 for r in found)
    scores = {r["doc_id"]: r["score"] for r in found}
    assert scores[1] == scores[2]
    assert rule_quality.score_quality(odd_documents(spark).limit(0), model).count() == 0


@pytest.fixture(scope="module")
def trees(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet")
    return boosted_rules.learn(docs, labels, keep=fold("doc_id", 5) != 0)


def test_trees_tell_held_out_labels(spark, trees):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    labels = spark.read.parquet(f"{TABLES}/labels.parquet").where(fold("doc_id", 5) == 0)
    rows = boosted_rules.judge(docs, trees).join(labels, "doc_id").collect()
    right = np.mean([(r["score"] >= 0.3) == r["quality"] for r in rows])
    assert right > 0.95
    for r in rows:
        failed = r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"]
        assert r["base_failed"] == failed and r["kept"] == (not failed and r["score"] >= 0.3)


def test_constraints_hold_everywhere(trees):
    drawn = np.random.default_rng(3)
    scale = np.array([8, 0.3, 2, 1, 1, 0.3, 60, 1, 1, 1, 900.0])
    rows = drawn.random((500, len(boosted_rules.INPUTS))) * scale
    for name, sign in boosted_rules.CONSTRAINTS.items():
        k = boosted_rules.INPUTS.index(name)
        steps = []
        for value in np.linspace(0, scale[k], 25):
            moved = rows.copy()
            moved[:, k] = value
            steps.append(trees.score(moved))
        assert (sign * np.diff(np.stack(steps), axis=0) >= -1e-12).all()


def test_constraints_hold_against_the_labels():
    drawn = np.random.default_rng(4)
    rows = drawn.random((800, len(boosted_rules.INPUTS)))
    k = boosted_rules.INPUTS.index("repeat_share")
    labels = (rows[:, k] + rows[:, 0] > 1).astype(float)
    grown = boosted_rules.fit(rows, labels)
    higher = rows.copy()
    higher[:, k] += 0.3
    assert (grown.score(higher) <= grown.score(rows) + 1e-12).all()
    free = boosted_rules.fit(rows, labels, constraints={})
    assert np.mean((free.score(rows) > 0.5) == labels) > 0.95


def test_flat_arrays_equal_a_walk(trees):
    rows = np.random.default_rng(5).random((40, len(boosted_rules.INPUTS))) * 3
    inner = trees.inputs.shape[1]
    for row, found in zip(rows, trees.score(rows), strict=True):
        total = trees.start
        for inputs, bounds, leaves in zip(trees.inputs, trees.bounds, trees.leaves, strict=True):
            node = 0
            while node < inner:
                node = 2 * node + (2 if row[inputs[node]] > bounds[node] else 1)
            total += leaves[node - inner]
        assert found == pytest.approx(1 / (1 + np.exp(-total)))


def test_trees_on_odd_rows(spark, trees):
    found = {r["doc_id"]: r for r in boosted_rules.judge(odd_documents(spark), trees).collect()}
    assert found[1]["n_words"] == 0 and found[1]["base_failed"] and not found[1]["kept"]
    assert found[3]["n_words"] == found[3]["n_repeat_words"] == 40_000
    assert boosted_rules.judge(odd_documents(spark).limit(0), trees).count() == 0
    none = spark.createDataFrame([], "doc_id long, quality int")
    untaught = boosted_rules.learn(odd_documents(spark), none)
    assert {r["score"] for r in boosted_rules.judge(odd_documents(spark), untaught).collect()} == {0.5}
