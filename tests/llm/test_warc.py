"""Archives: exact round trips, revisits, segments in any order, and damage."""

from __future__ import annotations

import gzip
import hashlib

import pytest

from lendscope.llm import warc


def expected(rows):
    first = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if page is not None and len(data) >= 100:
            first[data] = min(first.get(data, page), page)
    found = []
    for page, _, html in rows:
        data = (html or "").encode()
        refers = first.get(data) if page is not None and first.get(data) != page else None
        kind = "response" if refers is None else "revisit"
        found.append((page, len(data), hashlib.sha256(data).hexdigest(), kind, refers))
    return sorted(found, key=str)


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


ROWS = [
    (1, "http://a/", "x" * 99), (2, None, "x" * 99), (3, "http://b/\r\nX: y", "y" * 100),
    (9, "u", "y" * 100), (4, "u", "y" * 100), (5, "u", None), (6, "u", ""), (None, None, "z" * 200),
    (None, None, "z" * 200), (7, "u", "é\r\n\r\nWARC/1.1\r\n0\r\n\r\n" * 9000),
    (8, "u", "é\r\n\r\nWARC/1.1\r\n0\r\n\r\n" * 9000), (10, "u", "日本" * 40_000), (10, "u", "日本" * 40_000),
    (11, "ü", "\x00\r\n" * 50_000),
]


def test_pages_come_back(spark):
    found = warc.round_trip(pages(spark, ROWS)).collect()
    assert sorted(map(tuple, found), key=str) == expected(ROWS)


def test_empty_table(spark):
    assert warc.round_trip(pages(spark, []).limit(0)).collect() == []


def test_payloads_and_segments(spark, tmp_path):
    warc.write_archives(pages(spark, ROWS), f"{tmp_path}/out", segment_bytes=1000)
    read = warc.read_archives(spark, f"{tmp_path}/out").collect()
    payloads = {r["record_id"].split(":")[2]: r["payload"] for r in read if r["record_type"] == "response"}
    assert bytes(payloads["11"]).decode() == ROWS[-1][2]
    assert len(read) == len(ROWS)
    revisit = next(r for r in read if r["record_type"] == "revisit")
    assert revisit["payload"] is None and revisit["refers_to"]


def archive(tmp_path, parts):
    folder = tmp_path / "given"
    folder.mkdir()
    for k, part in enumerate(parts):
        (folder / f"{k}.warc.gz").write_bytes(gzip.compress(part))
    return str(folder)


def records(size=500):
    payload = bytes(range(256)) * 20
    digest = hashlib.sha256(payload).hexdigest()
    return payload, [r + b"\r\n\r\n" for r in warc.page_records(1, "u", payload, digest, None, size)]


def test_segments_in_any_order_and_file(spark, tmp_path):
    payload, made = records()
    assert len(made) > 5
    read = warc.read_archives(spark, archive(tmp_path, made[::-1])).collect()
    assert [bytes(r["payload"]) for r in read] == [payload]


def test_a_lost_segment_is_an_error(spark, tmp_path):
    _, made = records()
    with pytest.raises(Exception, match="segments are missing"):
        warc.read_archives(spark, archive(tmp_path, made[:2] + made[3:])).collect()


def test_members_and_plain_files():
    _, made = records()
    together = b"".join(made)
    members = b"".join(gzip.compress(m) for m in made)
    assert list(warc.records_in(together)) == list(warc.records_in(members))


def test_chunks_undo():
    for data in (b"", b"a", b"ab" * 5000):
        assert warc._unchunked(warc._chunked(data, 4096)) == data
    with pytest.raises(ValueError):
        warc._unchunked(b"5\r\nabc\r\n0\r\n\r\n")
