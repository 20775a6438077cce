"""The audit against plain enumeration, on awkward rows."""

from __future__ import annotations

import re
from itertools import permutations

import pytest

from lendscope.llm import filter_audit

LONG = " ".join(f"w{i}" for i in range(220))
DOCUMENTS = [
    (1, LONG, "en"), (2, LONG, "en"), (3, LONG, "de"), (3, LONG, "de"), (4, "# a a a", "en"),
    (5, "# a a a", None), (6, None, "de"), (7, "", "de"), (8, "AAA b", ""), (None, LONG, "en"),
    (None, LONG, "en"), (None, "only here", "de"), (9, LONG + " $", "en"), (9, LONG + " é", "en"),
    (10, "x " * 5000, "en"), (11, LONG, "en"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (4, 0, 1), (8, 1, None), (None, 1, 1), (77, 1, 1)]


def plain(documents, labels):
    """Every order, document by document."""
    good = {i for i, quality, _ in labels if quality == 1 and i is not None}
    toxic = {i for i, _, bad in labels if bad == 1 and i is not None}
    first = {}
    for doc_id, text, _ in documents:
        if doc_id is not None:
            first[text or ""] = min(first.get(text or "", doc_id), doc_id)
    rows = []
    for doc_id, text, lang in documents:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails = {
            "A": len(words) < 200,
            "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": text in first and (doc_id is None or first[text] < doc_id),
        }
        rows.append((lang or "", doc_id, {x for x in fails if fails[x]}))
    expected = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                out = [r for r in left if letter in r[2]]
                left = [r for r in left if letter not in r[2]]
                expected[part, "".join(order), step] = [
                    len(left), len(out),
                    sum(letter in r[2] for r in own) - len(out),
                    sum(r[2] == {letter} for r in own),
                    sum(r[1] in good for r in out), sum(r[1] in toxic for r in out),
                ]
    sums = {}
    for (part, order, step), counts in expected.items():
        key = part, order[step - 1]
        sums[key] = sums.get(key, 0) + counts[1]
    for (part, order, step), counts in expected.items():
        counts.append(sums[part, order[step - 1]])
    return expected


def tables(spark, documents, labels):
    docs = spark.createDataFrame(
        [(*r, "x", 1, 0) for r in documents],
        "doc_id long, text string, lang string, digest string, n int, mask int",
    )
    return docs, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def found(spark, documents, labels):
    rows = filter_audit.audit(*tables(spark, documents, labels)).collect()
    got = {(r["part"], r["filter_order"], r["step"]): list(r)[3:] for r in rows}
    assert len(got) == len(rows)
    return got


def test_audit_equals_enumeration(spark):
    assert found(spark, DOCUMENTS, LABELS) == plain(DOCUMENTS, LABELS)


def test_no_documents_no_rows_and_no_labels_no_losses(spark):
    assert found(spark, [], LABELS) == {}
    assert found(spark, DOCUMENTS[:4], []) == plain(DOCUMENTS[:4], [])


def test_a_part_for_every_language(spark):
    documents = [(i, f"text {i % 7}", f"lang {i % 40}") for i in range(120)]
    assert found(spark, documents, [(i, i % 2, 0) for i in range(60)]) == plain(
        documents, [(i, i % 2, 0) for i in range(60)]
    )


@pytest.mark.parametrize("letters", ["AB", "ABCDEF"])
def test_any_number_of_filters(spark, letters):
    cells = spark.createDataFrame(
        [("p", mask, mask + 1, 0, 0) for mask in range(2 ** len(letters))],
        "part string, mask int, n long, n_good long, n_toxic long",
    )
    rows = filter_audit.audit_orders(cells, letters).collect()
    orders = {"".join(o) for o in permutations(letters)}
    assert {r["filter_order"] for r in rows} == orders
    assert len(rows) == len(orders) * len(letters)
    for row in rows:
        bits = [letters.index(x) for x in row["filter_order"][: row["step"]]]
        free = sum(m + 1 for m in range(2 ** len(letters)) if not any(m >> b & 1 for b in bits))
        assert row["kept"] == free
