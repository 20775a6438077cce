"""Values against plain regular expressions, disclosing words against SQL and by hand."""

from __future__ import annotations

import hashlib
import random
import re

import duckdb
import pytest

from lendscope.llm import personal_data, sql

FORMS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def is_valid(kind, match):
    digits = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(part) <= 255 for part in match.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 if d > 9 else d for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def plain(text):
    spans = [
        (kind, m.start(), m.end())
        for kind, form in FORMS.items()
        for m in re.finditer(form, text or "")
        if is_valid(kind, m[0])
    ]
    counts = [sum(s[0] == kind for s in spans) for kind in FORMS]
    listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
    return (*counts, hashlib.sha256(listed.encode()).hexdigest(), listed)


def given(spark, texts):
    rows = [(i, text, "en", 1) for i, text in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, term string, digest int")


def found(spark, texts, **options):
    rows = personal_data.personal_data(given(spark, texts), **options).collect()
    assert len(rows) == len(texts)
    return {r["doc_id"]: tuple(r)[1:] for r in rows}


def made_texts():
    drawn = random.Random(3)
    parts = [
        "a", "Bo", "é", "日", "😀", " ", "  ", "\n", "\t", "-", ".", "@", "a@b.c", "x.y@", "%", "+", "+1",
        "4", "19", "255", "256", "0000255", "1.2.3.4", "1.2.3.4.5", "999.1.1.1", "4111 1111 1111 1111",
        "4111-1111-1111-1111", "5500000000000004", "123456789", "(", ")", "+49 (0) 30 1234567", ",",
        "_", "a@b.c%d@e.f", "a@b.c@d.e.f", "--", "9" * 25,
    ]
    made = ["".join(drawn.choice(parts) for _ in range(drawn.randint(0, 25))) for _ in range(600)]
    return [*made, None, "", "4111111111111111 " * 600, "a@b.c " * 700, "1.2.3.4 é " * 300]


def test_values_equal_plain_expressions(spark):
    texts = made_texts()
    got = found(spark, texts, support=10**6)
    for i, text in enumerate(texts):
        assert got[i] == plain(text), repr(text)


def test_very_long_texts(spark):
    """Deep repeats do not overflow a stack, and long runs and many matches take linear time."""
    texts = [
        "a" * 300_000, "1" * 300_000, "1 " * 200_000, "a." * 200_000, "a@" + "b." * 200_000 + "c",
        "+1" + " " * 300_000, "+1 " * 100_000, "1." * 200_000, "a@b.c " * 30_000,
    ]
    got = found(spark, texts, support=10**6)
    for i, text in enumerate(texts):
        ips = 50_000 if text.startswith("1.") else 0
        assert got[i][:4] == (text.count("@b."), ips, 0, 0)


def telling_texts():
    drawn = random.Random(5)
    words = [f"{a}{b}{c}" for a in "bdfg" for b in "aeiou" for c in "lmnrst"]
    line = lambda n: " ".join(drawn.choice(words) for _ in range(n))
    texts = ["\n".join(line(12) for _ in range(5)) for _ in range(60)]
    for i in range(5):
        texts.append(f"{line(3)} (Quentin) Abara, wrote from q.abara@mail.example.org {line(4)}\n{line(9)}")
        texts.append(f"{line(4)} Nuria called +1 (212) 555-0147 {line(3)}\n")
    texts += [f"Nuria {line(5)}" for _ in range(60)] + ["the Abara house\nand “Quentin”", "quentin abara"]
    return texts + texts[-70:-62] + [None, "", texts[61], texts[61]]


def against_sql(texts, rows):
    connection = duckdb.connect()
    connection.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    connection.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    return connection.execute(sql.personal_data()).fetchall()


@pytest.mark.parametrize("parts", [64, 1])
def test_disclosing_terms_equal_sql(spark, monkeypatch, parts):
    monkeypatch.setattr(personal_data, "_PARTS", parts)
    texts = telling_texts()
    expected = against_sql(texts, [[i, text] for i, text in enumerate(texts)])
    got = found(spark, texts)
    assert {r[0]: tuple(r[1:]) for r in expected} == got
    assert any("removed" in r[-1] for r in got.values())


def test_terms_that_tell_are_hidden_and_others_stay(spark):
    texts = telling_texts()
    telling = {r["term"]: r for r in personal_data.disclosing_terms(given(spark, texts), "text").collect()}
    assert telling["Abara"]["removed"] and telling["Quentin"]["removed"]
    assert telling["Abara"]["disclosure"] > 0.8
    assert "Nuria" not in telling or not telling["Nuria"]["removed"]
    cleaned = {i: r[-1] for i, r in found(spark, texts, clean=True).items()}
    for i, text in enumerate(texts):
        assert "Abara" not in cleaned[i] and "555-0147" not in cleaned[i]
        if text and "q.abara" in text:
            assert "<EMAIL>" in cleaned[i]
    at = texts.index("quentin abara")
    assert cleaned[at] == "quentin abara" and cleaned[texts.index("")] == ""


def test_terms_of_few_lines_are_not_judged(spark):
    one = "Only Zerlina writes as z@mail.example.org\n"
    assert personal_data.disclosing_terms(given(spark, [one] * 50 + ["other"]), "text").count() == 0


def test_null_and_repeated_ids(spark):
    rows = [(None, "a@b.c", 1), (None, "a@b.c", 1), (7, "x", 2), (7, "1.2.3.4", 3), (None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_email int")
    got = sorted((r["doc_id"] or -1, r["spans"]) for r in personal_data.personal_data(docs).collect())
    assert got == [(-1, ""), (-1, "email:0:5"), (-1, "email:0:5"), (7, ""), (7, "ip:0:7")]
    assert personal_data.personal_data(docs.limit(0)).collect() == []
