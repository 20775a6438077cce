"""License scans against the SQL of the query on texts made to be hard."""

from __future__ import annotations

import random

import duckdb
import pytest
from pyspark.sql import functions as F

from lendscope.llm import licenses, sql


def by_sql(rows):
    import pandas as pd

    connection = duckdb.connect()
    given = pd.DataFrame(rows, columns=["doc_id", "text"]).astype({"doc_id": "Int64", "text": "string"})
    connection.register("given", given)
    connection.execute("CREATE TABLE documents AS SELECT doc_id::BIGINT AS doc_id, text FROM given")
    return sorted(connection.execute(sql.license_notices()).fetchall(), key=str)


def run(spark, rows):
    found = licenses.scan(spark.createDataFrame(rows, "doc_id long, text string"))
    return sorted(map(tuple, found.collect()), key=str)


def made():
    drawn = random.Random(6)
    rows = []
    for i in range(60):
        name = drawn.choice(sorted(licenses.NOTICES))
        notice = licenses.NOTICES[name].split()
        for _ in range(drawn.randint(0, 3)):
            notice[drawn.randrange(len(notice))] = drawn.choice(["x", "the", "license"])
        before = [drawn.choice(["the", "license", "v", "under"]) for _ in range(drawn.randint(0, 90))]
        rows.append((i, " ".join(before + notice + before[:7])))
    return rows


def test_scans_equal_all_windows(spark):
    rows = made()
    found = run(spark, rows)
    assert found == by_sql(rows) and len(found) > 20


def test_odd_rows(spark):
    notice = licenses.NOTICES["GPL-3.0"]
    rows = [
        (1, None), (2, ""), (3, "license"), (4, notice.upper()), (5, f"{notice} {notice}"),
        (6, "w " * 60_000 + notice), (7, notice.replace(" ", "\n-- ")), (8, "Released under the MIT"),
    ]
    found = run(spark, rows)
    assert {r[0] for r in found} == {4, 5, 6, 7}
    docs = spark.createDataFrame([(1, notice, 1)], "doc_id long, text string, license int")
    assert licenses.scan(docs).count() == 1
    assert licenses.scan(docs.limit(0)).count() == 0
    twice = licenses.scan(docs.union(docs)).collect()
    assert len(twice) == 1
    unnamed = spark.createDataFrame([(None, notice)], "doc_id long, text string")
    assert licenses.scan(unnamed).head()["doc_id"] is None


def test_rows_under_one_id_count_each(spark):
    mit, gpl = licenses.NOTICES["MIT"], licenses.NOTICES["GPL-3.0"]
    rows = [
        (1, mit), (1, mit), (1, f"{mit} and a word"), (1, gpl), (2, f"{mit} {mit} {gpl}"),
        (None, mit), (None, mit), (3, f"a b c {gpl}"), (3, f"x y z {gpl} and then much more of it"),
    ]
    found = run(spark, rows)
    assert found == by_sql(rows)
    windows = {(r[0], r[1]): r[4] for r in found}
    assert windows[1, "MIT"] == 3 and windows[None, "MIT"] == 2


def test_notices_of_one_family_are_told_apart(spark):
    names = [
        "GPL-2.0-or-later", "GPL-3.0-or-later", "LGPL", "AGPL", "MPL-2.0", "Unlicense",
        "CC0-1.0", "CC-BY-SA-4.0", "CC-BY-4.0", "MIT-disclaimer", "BSD-disclaimer",
    ]
    rows = [(i, f"Some words before. {licenses.NOTICES[n]} Some after.") for i, n in enumerate(names)]
    found = run(spark, rows)
    assert sorted((r[0], r[1]) for r in found) == list(enumerate(names))
    assert found == by_sql(rows)


def test_each_shingle_of_a_template_holds_an_anchor():
    chosen = set(licenses.anchors(licenses.NOTICES))
    for notice in licenses.NOTICES.values():
        words = licenses._template_words(notice)
        assert len(words) >= licenses.WIDTH
        for i in range(len(words) - licenses.WIDTH + 1):
            assert chosen & set(words[i : i + licenses.WIDTH])


def test_windows_hold_their_templates():
    for words in range(5, 400):
        assert 2 * words <= licenses.window_words(words) <= max(4 * words, 12)


def test_no_python_on_the_way(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = licenses.scan(docs)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_short_templates_are_refused(spark):
    with pytest.raises(ValueError):
        licenses.templates(spark, {"short": "one two three"})


def test_marks_beyond_ascii_part_words(spark):
    apache, mit = licenses.NOTICES["Apache-2.0"], licenses.NOTICES["MIT"]
    rows = [
        (1, apache.replace("Version 2.0", "Version\u00a02.0")), (2, f"\u201c{mit}\u201d"),
        (3, f"\u2022{mit}\u2014{apache}"), (4, mit.replace(" ", "\u2003")),
        (5, f"\U0001f600{mit}"), (6, mit.replace("the", "th\u00e9")),
        (7, mit.replace("the", "the\u0301")), (8, mit.replace("the", "the\u4e2d")),
    ]
    found = {(r[0], r[1]) for r in run(spark, rows)}
    assert found == {(1, "Apache-2.0"), (2, "MIT"), (3, "MIT"), (3, "Apache-2.0"), (4, "MIT"), (5, "MIT")}


def test_words_of_templates_are_words_of_texts(spark):
    text = "A b\u201cc\u201d d\u2014e \u2022f g\u0301h \u4e2d\u6587 x\u0663 9\u00bd _k\u00a0l M\u00b7n \u2160"
    (row,) = spark.createDataFrame([(text,)], "t string").select(licenses.words_of(F.col("t"))).collect()
    assert row[0] == licenses._template_words(text)
