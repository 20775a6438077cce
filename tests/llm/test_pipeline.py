"""The stages against brute-force versions of what they decide."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from lendscope.llm import language_crf, rule_quality
from test_near_dedup import brute

TABLES = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    found = [docs]
    for _, stage in pipeline.STAGES:
        docs = stage(spark, docs, TABLES)
        docs = docs.persist()
        found.append(docs)
    return found


def test_columns(steps):
    for docs in steps[:-1]:
        assert docs.columns == pipeline.COLUMNS


def test_languages_keep_texts_with_letters(steps):
    before = {r["doc_id"]: r["text"] for r in steps[0].collect()}
    kept = {r["doc_id"] for r in steps[1].collect()}
    model = language_crf.learn(steps[0])
    found = {r["doc_id"]: r for r in language_crf.identify(steps[0], model).collect()}
    assert kept == {
        i for i in before if found[i]["lang_pred"] != "und" and found[i]["score"] >= 0.5
    }
    assert len(kept) > 0.9 * len(before)


def test_quality_keeps_good_labels(spark, steps):
    labels = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{TABLES}/labels.parquet").collect()}
    kept = {r["doc_id"] for r in steps[2].collect()}
    before = {r["doc_id"] for r in steps[1].collect()}
    known = [(i in kept, labels[i]) for i in before if i in labels]
    assert sum(a == b for a, b in known) > 0.95 * len(known)
    model = rule_quality.learn(steps[1], spark.read.parquet(f"{TABLES}/labels.parquet"))
    scores = rule_quality.score_quality(steps[1], model).collect()
    assert kept == {r["doc_id"] for r in scores if r["score"] >= 0.3}


def test_one_of_each_group_stays(steps):
    rows = [(r["doc_id"], r["text"]) for r in steps[2].collect()]
    kept = [r["doc_id"] for r in steps[3].collect()]
    assert sorted(kept) == sorted(i for i, _, _, own in brute(rows, 5) if own)


def test_mixing_keeps_the_budget(steps):
    before = {r["doc_id"]: r for r in steps[3].collect()}
    taken = steps[4].collect()
    assert all(tuple(r) == tuple(before[r["doc_id"]]) for r in taken)
    budget = sum(len(r["text"].split()) for r in before.values())
    assert 0.8 * budget < sum(len(r["text"].split()) for r in taken) <= budget


def test_encoding_is_whole(steps):
    assert steps[5].where("not round_trip").count() == 0
    assert Counter(r[0] for r in steps[4].select("doc_id").collect()) == Counter(
        r[0] for r in steps[5].select("doc_id").collect()
    )


def test_run_gives_the_last_stage(spark):
    assert pipeline.run(spark, TABLES).columns[:2] == ["doc_id", "n_pieces"]


def _documents(spark, rows):
    given = [(i, text, "en", source, len(text or "")) for i, text, source in rows]
    kinds = "doc_id long, text string, lang string, source string, n_chars int"
    return spark.createDataFrame(given, kinds)


def _prose(word, count=40):
    return " ".join(f"{word}{k}" for k in range(count))


def test_null_and_shared_ids_stay(spark):
    near = _prose("a") + " more"
    rows = [
        (None, _prose("n"), "x"), (None, _prose("m"), "x"), (None, _prose("m"), "x"),
        (None, _prose("a"), "x"), (3, near, "x"), (7, _prose("z"), "x"), (7, _prose("b"), "x"),
        (8, _prose("c") + " v", "x"), (8, _prose("c") + " u", "x"), (9, " ", "x"), (9, " ", "x"),
        (9, None, "x"), (None, " ", "x"), (None, " ", "x"),
    ]
    wanted = [
        (None, _prose("n")), (None, _prose("m")), (3, near), (7, _prose("z")), (7, _prose("b")),
        (8, _prose("c") + " u"), (9, " "), (9, None), (None, " "), (None, " "),
    ]
    for given in (rows, rows[::-1]):
        kept = pipeline.one_of_each_group(spark, _documents(spark, given), TABLES).collect()
        assert Counter((r["doc_id"], r["text"]) for r in kept) == Counter(wanted)


def test_mixing_tells_rows_with_null_and_shared_ids_apart(spark):
    rows = [(None, _prose(f"n{i}x"), "ab"[i % 2]) for i in range(30)]
    rows += [(5, _prose(f"s{i}x"), "a") for i in range(30)]
    taken = pipeline.mixed_sources(spark, _documents(spark, rows), TABLES).collect()
    assert {(r["doc_id"], r["text"], r["source"]) for r in taken} <= set(rows)
    budget = sum(len(text.split()) for _, text, _ in rows)
    assert 0.8 * budget < sum(len(r["text"].split()) for r in taken) <= budget
    # The small source is repeated evenly, the large one is not repeated.
    times = Counter(r["text"] for r in taken)
    assert max(times.values()) <= 4 and len(times) > 40
    again = pipeline.mixed_sources(spark, _documents(spark, rows[::-1]), TABLES).collect()
    assert times == Counter(r["text"] for r in again)


def test_mixed_languages_stay(spark):
    docs = spark.read.parquet(f"{TABLES}/documents.parquet")
    words = {}
    for r in docs.orderBy("doc_id").collect():
        words.setdefault(r["lang"], []).extend((r["text"] or "").split())
    mixes = [
        {"en": 60, "de": 60}, {"en": 40, "de": 35, "fr": 25}, {"es": 40, "fr": 40, "de": 40},
        {"en": 30, "de": 30, "fr": 30, "es": 30},
    ]
    rows = [
        (-1 - i, " ".join(w for lang, n in mix.items() for w in words[lang][500 : 500 + n]), "x")
        for i, mix in enumerate(mixes)
    ]
    # Each wrongly labelled once, so each is learned from, and two are there twice.
    others = [
        "これは日本語の文章です", "Это русский текст о погоде", "한국어 문장입니다 오늘은",
        "zzz qqq xxkj", "xkqj wvvz",
    ]
    rows += [(-10 - i, text, "x") for i, text in enumerate(others + others[:2])]
    rows += [(-30, "12 34", "x"), (-31, None, "x")]
    given = docs.select(*pipeline.COLUMNS).unionByName(
        _documents(spark, rows).withColumn("n_chars", F.col("n_chars").cast(docs.schema["n_chars"].dataType))
    )
    kept = {r["doc_id"] for r in pipeline.known_languages(spark, given, TABLES).collect()}
    assert {i for i in kept if i < 0} == {-1, -2, -3, -4}


def test_rows_that_go_are_exact_and_texts_that_stay_are_not_shuffled(spark, monkeypatch):
    rows = spark.range(3000).select(
        (F.col("id") * (1 << 33) + F.col("id") % 7).alias("row_key"),
        F.repeat(F.md5(F.col("id").cast("string")), 50).alias("text"),
    )
    gone = rows.where("pmod(hash(row_key), 10) = 0").select("row_key")
    expected = sorted(r[0] for r in rows.join(gone, "row_key", "left_anti").select("row_key").collect())
    for bits in (pipeline._BITS, 64, 1 << 10):  # few bits: most rows share one
        monkeypatch.setattr(pipeline, "_BITS", bits)
        left = pipeline.without(rows, gone)
        assert sorted(r["row_key"] for r in left.collect()) == expected
        assert left.columns == rows.columns
    assert pipeline.without(rows, gone.limit(0)).count() == 3000


def test_near_dedup_drops_what_it_stored_for_links(spark):
    docs = _documents(spark, [(i, f"{i % 5} one two three four five six seven", "s") for i in range(20)])
    written = []
    with pipeline.recording(written):
        kept = pipeline.one_of_each_group(spark, docs, TABLES)
        assert sorted(r["doc_id"] for r in kept.collect()) == [0, 1, 2, 3, 4]
    labels = {path.rsplit("/", 1)[-1].rsplit("-", 1)[0] for path in written}
    assert labels == {"row-keys", "near-groups", "near-firsts", "near-gone"}
    plan = kept._jdf.queryExecution().toString()
    assert "LeftSemi" not in plan
