"""Raw CSV files with everything that can be in them, cleaned and loaded."""

from __future__ import annotations

import datetime as dt
import random
import re
from decimal import Decimal

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lendscope.model import LOAN_COLUMNS, NA_TOKENS
from lendscope.operators import cleaning, conform, profiling, sinks
from lendscope.operators.naming import HeaderCollision
from lendscope.plans import jobs
from lendscope.session import scratch_path, sized_shuffles
from lendscope.sources import csv_files, spanning
from lendscope.sources.discover import discover, require
from lendscope.streaming.chunked_load import load_in_chunks

HEADER_7A = (
    "AsOfDate,Program,L2LocID,BorrName,BorrState,BorrZip,BankName,GrossApproval,ApprovalDate,"
    "ApprovalFiscalYear,InitialInterestRate,TermInMonths,NAICSCode,LoanStatus,JobsSupported"
)
ROWS_7A = [
    '12/31/2025,7A,1,"He said ""hi"", ok",CA,02134,Bank A,"$1,234.50",1/5/2020,2020,6.25,120,'
    "722511,EXEMPT,5",
    '12/31/2025,7A,2,"Line\nbreak",TX,73301,NULL,1000,2/29/2020,2020.0,5,60,111110,P I F,abc',
    # an exact copy of the row above, and one with outer spaces
    '12/31/2025,7A,2,"Line\nbreak",TX,73301,NULL,1000,2/29/2020,2020.0,5,60,111110,P I F,abc',
    '12/31/2025,7A,2,"Line\nbreak ", TX,73301,NULL,1000,2/29/2020,2020.0,5,60,111110 ,P I F,abc',
    # the same but for how the amount is written
    '12/31/2025,7A,2,"Line\nbreak",TX,73301,NULL,"1,000",2/29/2020,2020.0,5,60,111110,P I F,abc',
    "12/31/2025,7A,3,Both files,NY,10001,Bank B,500,3/1/2021,2021,,36.5,722511,EXEMPT,7",
    '12/31/2025,7A,4, NULL ,NY,10001, Bank C ,(500),13/1/2021,2021,x,36,"",#N/A,8',
]
HEADER_504 = (
    "AsOfDate,Program,L2LocID,BorrName,BORRSTATE,BorrZip,CDC_Name,ThirdPartyLender_Name,"
    "ThirdPartyDollars,Gross Approval,ApprovalDate,NAICSCode,NotInTable"
)
ROWS_504 = [
    "12/31/2025,504,10,First,CA,90001,CDC One,Third One,100,2000,2001-05-06,621210,x",
    "12/31/2025,504,11,Second,CA,90001,CDC One,,100,3000,2001-05-06,621210,y",
    "12/31/2025,504,12,Third,CA,90001,n/a,   ,100,4000,2001-05-06,621210,z",
]


def write(folder, name, header, rows, end="\n"):
    folder.mkdir(exist_ok=True, parents=True)
    text = end.join([header, *rows]) + end
    (folder / name).write_bytes(text.encode("utf-8"))
    return folder / name


@pytest.fixture
def folder(tmp_path):
    raw = tmp_path / "raw files"
    write(raw, "loans_7a.csv", HEADER_7A, ROWS_7A)
    write(raw, "loans_504.csv", HEADER_504, ROWS_504)
    # a row that another file also has: both are kept
    write(raw, "more_7a.csv", "﻿" + HEADER_7A, [ROWS_7A[5]], end="\r\n")
    return raw


def test_first_candidate_with_files_wins(spark, folder, tmp_path):
    found = discover(spark, [f"{tmp_path}/none/*.csv", [f"{tmp_path}/no.csv"], str(folder), "/etc"])
    assert [f.path.rsplit("/", 1)[1] for f in found] == [
        "loans_504.csv", "loans_7a.csv", "more_7a.csv",
    ]
    exact = discover(spark, [[f"{folder}/no.csv", f"{folder}/more_7a.csv"]])
    assert len(exact) == 1
    assert discover(spark, [f"{tmp_path}/none/*.csv"]) == []
    with pytest.raises(FileNotFoundError):
        require([], "nowhere")
    with pytest.raises(FileNotFoundError):
        jobs.clean_job(spark, [f"{tmp_path}/none"], str(tmp_path / "out"))
    with pytest.raises(ValueError):
        csv_files.union_by_name([])


@pytest.mark.parametrize("line_breaks", ["check", "any"])
@pytest.mark.parametrize("piece", ["128MB", "256b"])
def test_clean_job(spark, folder, tmp_path, line_breaks, piece):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    try:
        result = jobs.clean_job(spark, [str(folder)], str(tmp_path / "clean"), line_breaks)
        rows = {(r.loan_id, r.source_file): r for r in result.cleaned.collect()}
        summary = result.summary.first()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)

    assert summary.row_count == 9
    assert summary.duplicate_rows_removed == 2
    first = rows["1", "loans_7a.csv"]
    assert first.borrower_name == 'He said "hi", ok'
    assert first.borrower_zip == "02134"
    assert first.loan_amount == Decimal("1234.50")
    assert first.as_of_date == dt.date(2025, 12, 31)
    assert first.approval_fiscal_year == 2020
    assert first.initial_interest_rate == Decimal("6.2500")
    second = [r for r in result.cleaned.collect() if r.loan_id == "2"]
    assert len(second) == 2  # "1,000" and "1000" are different rows
    assert {r.loan_amount for r in second} == {Decimal("1000.00")}
    assert {r.borrower_name for r in second} == {"Line\nbreak"}
    assert {r.lender_name for r in second} == {None}
    assert {r.jobs_supported for r in second} == {None}
    assert ("3", "loans_7a.csv") in rows and ("3", "more_7a.csv") in rows
    assert rows["3", "loans_7a.csv"].term_in_months is None
    fourth = rows["4", "loans_7a.csv"]
    assert fourth.borrower_name == "NULL"  # became a token only after trimming
    assert fourth.lender_name == "Bank C"
    assert fourth.loan_amount is None and fourth.approval_date is None
    assert fourth.naics_code is None and fourth.loan_status is None
    assert [rows[i, "loans_504.csv"].lender_name for i in ("10", "11", "12")] == [
        "Third One", "CDC One", None,
    ]
    assert rows["10", "loans_504.csv"].approval_date == dt.date(2001, 5, 6)
    failures = {r.column_name: r.failed_values for r in result.coercion_failures.collect()}
    assert failures["loan_amount"] == 1
    assert failures["jobs_supported"] == 4
    assert failures["term_in_months"] == 2
    assert failures["approval_date"] == 1


def test_cleaning_again_changes_nothing(spark, folder, tmp_path):
    result = jobs.clean_job(spark, [str(folder)], str(tmp_path / "clean"))
    again = cleaning.clean(result.cleaned)
    # but that rows which differed only in how a number was written are now equal
    assert again.count() == 8
    assert set(map(str, again.collect())) == set(map(str, result.cleaned.collect()))
    once = conform.prepare(result.cleaned)
    assert sorted(map(str, conform.prepare(once).collect())) == sorted(map(str, once.collect()))


def test_load_job(spark, folder, tmp_path):
    cleaned = jobs.clean_job(spark, [str(folder)], str(tmp_path / "clean"))
    result = jobs.load_job(spark, cleaned.path, "loans_loaded")
    table = result.loans
    assert [c for c in sinks.TABLE_SCHEMA.names if c not in table.columns] == []
    assert dict(table.dtypes)["loan_id"] == "bigint"
    assert table.count() == 9
    assert table.select("loan_row_id").distinct().count() == 9
    assert [r.borrower_name for r in table.where("loan_id = 4").collect()] == [None]
    status = {r.column_name: r.status for r in result.columns.collect()}
    assert status["not_in_table"] == "extra"
    assert status["bank_street"] == "absent"
    chunks = result.chunks.collect()
    assert sum(r.chunk_rows for r in chunks) == 9
    assert max(r.rows_loaded for r in chunks) == 9
    assert {r.total_rows for r in chunks} == {9}

    views = jobs.view_job(spark, "loans_loaded")
    assert spark.sql("SELECT * FROM vw_state_funding").count() == 3
    assert len(views) == 4
    with pytest.raises(ValueError):
        jobs.view_job(spark, "no_such_table")

    # a second load replaces the rows
    assert jobs.load_job(spark, cleaned.path, "loans_loaded").loans.count() == 9
    sinks.create_table(spark, "loans_loaded")
    assert not sinks.has_rows(spark.table("loans_loaded"))


def test_csv_round_trip(spark, folder, tmp_path):
    cleaned = jobs.clean_job(spark, [str(folder)], str(tmp_path / "clean")).cleaned
    path = sinks.save_clean(cleaned, str(tmp_path / "csv"), "csv")
    again = conform.conform(sinks.read_clean(spark, path, "csv"))
    expected = conform.conform(cleaned)
    assert sorted(map(str, again.collect())) == sorted(map(str, expected.collect()))
    assert again.columns == LOAN_COLUMNS


def test_chunked_load_goes_on_where_it_stopped(spark, folder, tmp_path):
    cleaned = jobs.clean_job(spark, [str(folder)], str(tmp_path / "clean")).cleaned
    source, target = str(tmp_path / "source"), str(tmp_path / "table")
    notes = str(tmp_path / "notes")
    cleaned.repartition(3).write.parquet(source)
    for extra in (0, 1):
        if extra:
            cleaned.limit(2).write.mode("append").parquet(source)
        load_in_chunks(spark, source, cleaned.schema, target, notes, files_per_chunk=1)
        load_in_chunks(spark, source, cleaned.schema, target, notes, bytes_per_chunk=1000)
        loaded = sinks.read_table_files(spark, target)
        assert loaded.count() == loaded.select("loan_row_id").distinct().count() == 9 + 2 * extra
    with pytest.raises(ValueError):
        load_in_chunks(spark, source, cleaned.schema, target, notes)

    def contiguous():
        keyed = sinks.with_contiguous_keys(sinks.read_table_files(spark, target))
        assert keyed.columns == sinks.TABLE_SCHEMA.names
        return sorted(r[0] for r in keyed.select("loan_row_id").collect())

    assert contiguous() == list(range(1, 12))
    # The last chunk is begun anew when its end was not noted.
    last = max((p for p in (tmp_path / "notes" / "commits").glob("[0-9]*")), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    load_in_chunks(spark, source, cleaned.schema, target, notes, files_per_chunk=1)
    assert contiguous() == list(range(1, 12))


def test_contiguous_keys_keep_order_and_take_a_shuffle_beyond_the_bound(spark, monkeypatch):
    rows = spark.range(0, 5000, 1, 7).selectExpr("id AS borrower_state")
    table = sinks.with_row_key(rows).persist()
    for bound in (500_000, 0):
        monkeypatch.setattr(sinks, "MOST_RUNS", bound)
        keyed = sinks.with_contiguous_keys(table).orderBy("loan_row_id").collect()
        assert [(r[0], r[1]) for r in keyed] == [(i + 1, i) for i in range(5000)]
    assert sinks.with_contiguous_keys(table.limit(0)).count() == 0
    table.unpersist()


def test_tokens_are_null_and_others_are_not(spark, tmp_path):
    cells = [*NA_TOKENS, " ", "NULLS", "none"]
    write(tmp_path, "t.csv", "id,cell", [f'{i},"{c}"' for i, c in enumerate(cells)])
    files = discover(spark, [str(tmp_path)])
    raw = csv_files.read_raw(spark, files)
    kept = {r.cell for r in raw.where("cell is not null").collect()}
    assert kept == {"NULLS", "none"}
    typed = csv_files.read_raw(spark, files, NA_TOKENS)
    assert typed.where("cell = ' '").count() == 1


def test_types(spark, tmp_path):
    rows = ["1,1,1.5,5D,,1", "2,NA,2,x,NA,99999999999999999999", "-3,3,1e5,7,,2"]
    write(tmp_path, "t.csv", "a,b,c,d,e,f", rows)
    frame = csv_files.read_typed(spark, discover(spark, [str(tmp_path)]))
    assert dict(frame.dtypes) == {
        "a": "bigint", "b": "bigint", "c": "double", "d": "string", "e": "double", "f": "double",
        "source_file": "string",
    }
    profile = {r.column_name: r.missing_values for r in profiling.column_profile(frame).collect()}
    assert profile == {"a": 0, "b": 1, "c": 0, "d": 0, "e": 3, "f": 0, "source_file": 0}


def test_collision_and_surplus_cells_fail(spark, tmp_path):
    write(tmp_path / "a", "t.csv", "BorrName,borr_name", ["x,y"])
    with pytest.raises(HeaderCollision):
        csv_files.read_raw(spark, discover(spark, [str(tmp_path / "a")]))
    write(tmp_path / "b", "t.csv", "a,b", ["1,2", "1,2,3", "1"])
    frame = csv_files.read_raw(spark, discover(spark, [str(tmp_path / "b")]))
    with pytest.raises(Exception, match="more cells than its header"):
        frame.count()
    write(tmp_path / "c", "t.csv", "a,b", ["1,2", "1"])
    frame = csv_files.read_raw(spark, discover(spark, [str(tmp_path / "c")]))
    assert frame.where("b is null").count() == 1


def test_large_files_are_cut_only_without_spanning_cells(spark, tmp_path):
    rows = [f"{i},plain text number {i}" for i in range(2000)]
    write(tmp_path, "cut.csv", "id,text", rows)
    write(tmp_path, "whole.csv", "id,text", [*rows[:500], '500,"two\nlines"', *rows[501:]])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        files = discover(spark, [str(tmp_path)])
        found = {
            lay.paths[0].rsplit("/", 1)[1]: lay.way
            for lay in csv_files.layouts(spark, files)
        }
        raw = csv_files.read_raw(spark, files)
        assert raw.rdd.getNumPartitions() > 3
        assert raw.select("id", "source_file").distinct().count() == 4000
        assert raw.where("text = 'two\nlines'").count() == 1
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert found == {"cut.csv": "cut", "whole.csv": "joined"}


def test_preview_is_the_head_of_every_file(spark, tmp_path):
    for name, n in (("a.csv", 3000), ("b.csv", 10)):
        write(tmp_path / "raw", name, "id,text", [f"{i},row {i}" for i in range(n)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        report = jobs.profile_job(spark, [str(tmp_path / "raw")], str(tmp_path / "pre"), 500)
        lines = {(r.source_file, r.column_name): r for r in report.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert lines["a.csv", "id"].row_count == 3000 and lines["a.csv", "id"].dtype == "bigint"
    assert lines["b.csv", "text"].dtype == "string" and lines["b.csv", "text"].column_count == 2
    for name, n in (("a", 500), ("b", 10)):
        parts = sorted((tmp_path / "pre").glob(f"preview={name}-*/*.csv"))
        assert len(parts) == 1
        text = parts[0].read_text().splitlines()
        assert text == ["id,text", *[f"{i},row {i}" for i in range(n)]]


def test_jobs_use_the_named_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_shuffles_follow_the_size_of_the_input(spark):
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    with sized_shuffles(spark, 1024**4):
        assert spark.conf.get(setting) == "8192"
    with sized_shuffles(spark, 100 * 1024**4):
        assert spark.conf.get(setting) == "819200"
    with sized_shuffles(spark, 100 * 1024**4, most=1000):
        assert spark.conf.get(setting) == "1000"
    with sized_shuffles(spark, 1):
        assert spark.conf.get(setting) == before
    assert spark.conf.get(setting) == before


@pytest.mark.parametrize(("end", "piece"), [("\n", "200b"), ("\r\n", "200b"), ("\n", "2k")])
def test_rows_that_span_pieces(spark, tmp_path, end, piece):
    """Cells with line breaks, some longer than a piece, come back whole and in place."""
    texts = [
        "" if i % 7 == 3 else f"row {i}" + "".join(f'{end}line "{j}", of {i}' for j in range(i % 5))
        for i in range(120)
    ]
    texts[100] = end.join("long" * 30 for _ in range(5))
    rows = ['{},"{}",z'.format(i, t.replace('"', '""')) for i, t in enumerate(texts)]
    rows.insert(50, "")
    for name in ("a.csv", "b.csv"):
        write(tmp_path / "raw", name, f'id,"te{end}xt",last', rows, end)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        files = discover(spark, [str(tmp_path / "raw")])
        (layout,) = csv_files.layouts(spark, files)
        assert layout.way == "joined"
        raw = csv_files.scan(spark, layout, ["id", "text", "last"], position=True)
        found = raw.orderBy("source_path", "block_start", "row_order").collect()
        kept = sinks.first_rows(raw, 20).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.unset("spark.sql.files.openCostInBytes")
    expected = [(str(i), t.replace("\r\n", "\n") or "", "z") for i, t in enumerate(texts)]
    assert [(r.id, r.text or "", r.last) for r in found] == expected * 2
    assert {(r.source_file, r.id) for r in kept} == {
        (name, str(i)) for name in ("a.csv", "b.csv") for i in range(20)
    }


SIZES = ["128MB", "200b"]


@pytest.fixture(params=SIZES)
def piece(request, spark):
    """Files of one piece, and files cut into many."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", request.param)
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    yield request.param
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@pytest.mark.parametrize("spanning", [False, True])
def test_stray_quotes_are_text(spark, tmp_path, piece, spanning):
    texts = [f"plain {i}" for i in range(100)]
    texts[20], texts[21], texts[60] = '5" pipe', 'say "hi" now', '"'.join("abc")
    rows = [f"{i},{t},z" for i, t in enumerate(texts)]
    if spanning:
        rows[40], texts[40] = '40,"two\nlines, ""q"" 5"" x",z', 'two\nlines, "q" 5" x'
        rows[70], texts[70] = '70,"\n\n",z', "\n\n"
    write(tmp_path, "t.csv", 'id,5" header,last', rows)
    files = discover(spark, [str(tmp_path)])
    (layout,) = csv_files.layouts(spark, files)
    assert layout.headers == ("id", '5" header', "last")
    assert layout.way == ("joined" if spanning else "cut")
    found = csv_files.scan(spark, layout, ["id", "text", "last"]).collect()
    assert sorted((int(r.id), r.text, r.last) for r in found) == [
        (i, t, "z") for i, t in enumerate(texts)
    ]


@pytest.mark.parametrize("spanning", [False, True])
def test_blank_lines_before_the_header(spark, tmp_path, piece, spanning):
    rows = [f"{i},text {i}" for i in range(40)]
    rows[5:5] = ["", "  "]
    if spanning:
        rows[30] = '28,"a\nb"'
    write(tmp_path, "t.csv", "\n  \nid,text", rows)
    raw = csv_files.read_raw(spark, discover(spark, [str(tmp_path)]))
    assert sorted(int(r.id) for r in raw.collect()) == list(range(40))


def test_long_cells_and_headers_that_span_pieces(spark, tmp_path, piece):
    long = "x\n" * 300
    header = '"first\n' + "part, " * 60 + '",second'
    write(tmp_path, "t.csv", header, [f'1,"{long}"', "2,b", f'3,"{long}"'])
    (layout,) = csv_files.layouts(spark, discover(spark, [str(tmp_path)]))
    assert layout.headers == ("first\n" + "part, " * 60, "second")
    found = csv_files.scan(spark, layout, ["a", "b"]).collect()
    assert sorted((r.a, r.b) for r in found) == [("1", long), ("2", "b"), ("3", long)]


@pytest.mark.parametrize("row", ["1,2,3", "1,2,", "1,2,,", "1,2,,LOST", '1,"2",""', ",,,"])
@pytest.mark.parametrize("spanning", [False, True])
def test_surplus_cells_fail_whatever_they_hold(spark, tmp_path, piece, row, spanning):
    rows = ["1,2", "1", '"a\nb",c' if spanning else "a,c", *["7,8"] * 50, row]
    write(tmp_path, "t.csv", "a,b", rows)
    raw = csv_files.read_raw(spark, discover(spark, [str(tmp_path)]))
    with pytest.raises(Exception, match="more cells than its header"):
        raw.count()
    write(tmp_path / "good", "t.csv", "a,b", rows[:-1])
    good = csv_files.read_raw(spark, discover(spark, [str(tmp_path / "good")]))
    assert good.count() == 53 and good.where("b is null").count() == 1


def test_a_cell_that_is_never_closed_fails(spark, tmp_path, piece):
    write(tmp_path, "t.csv", "a,b", ["1,2", '3,"open', *["4,5"] * 100])
    with pytest.raises(Exception, match="never closed"):
        csv_files.read_raw(spark, discover(spark, [str(tmp_path)])).count()
    write(tmp_path / "h", "t.csv", 'a,"b', ["1,2"] * 100)
    with pytest.raises(Exception, match="never closed"):
        csv_files.read_raw(spark, discover(spark, [str(tmp_path / "h")])).count()


def test_many_pieces_inside_cells_are_joined_by_a_shuffle(spark, tmp_path, piece, monkeypatch):
    from lendscope.sources import spanning

    monkeypatch.setattr(spanning, "MOST_BROADCAST", 0)
    rows = [f'{i},"a\n{"long" * 40}\nb"' for i in range(30)]
    write(tmp_path, "t.csv", "id,text", rows)
    raw = csv_files.read_raw(spark, discover(spark, [str(tmp_path)]))
    assert {r.id: r.text for r in raw.collect()} == {
        str(i): "a\n" + "long" * 40 + "\nb" for i in range(30)
    }



@pytest.mark.parametrize("header", ["Loan No.,b", "Name,Name", "Name,NAME", '"a,b","x`y"', "b c,%;"])
def test_any_header_is_profiled_and_previews_are_replaced(spark, tmp_path, header):
    for folder in ("one", "two"):
        write(tmp_path / folder, "x.csv", header, [f"{i},{folder}" for i in range(30)])
    for _ in range(2):
        report = jobs.profile_job(
            spark, [[f"{tmp_path}/one/x.csv", f"{tmp_path}/two/x.csv"]], str(tmp_path / "pre"), 10
        ).collect()
    assert len(report) == 4 and {r.row_count for r in report} == {30}
    (first,) = csv_files.layouts(spark, discover(spark, [f"{tmp_path}/one/*.csv"]))
    assert [r.column_name for r in sorted(report, key=lambda r: r.column_position)][::2] == list(
        first.headers
    )
    previews = sorted((tmp_path / "pre").glob("preview=x-*"))
    assert len(previews) == 2
    for folder in previews:
        (part,) = folder.glob("*.csv")
        assert len(part.read_text().splitlines()) == 11


def test_cleaning_twice_replaces_the_output(spark, folder, tmp_path):
    for _ in range(2):
        result = jobs.clean_job(spark, [str(folder)], str(tmp_path / "clean"))
        assert result.cleaned.count() == 9


@pytest.mark.parametrize("line_breaks", ["check", "none", "any"])
@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("lone", ["quoted", "plain", "header"])
def test_a_cr_inside_a_line_is_text(spark, tmp_path, piece, lone, end, line_breaks):
    first = {"quoted": '"x\ry"', "plain": "x\ry"}.get(lone, "x")
    header = "na\rme" if lone == "header" else "name"
    rows = [f"{first},1", "second,2", "third,3"]
    write(tmp_path / "raw", "a.csv", f"{header},rank", rows, end)
    [layout] = csv_files.layouts(spark, discover(spark, [str(tmp_path / "raw/*.csv")]), line_breaks)
    assert layout.headers == (header, "rank")
    found = csv_files.scan(spark, layout, ["name", "rank"]).select("name", "rank").collect()
    value = "x" if lone == "header" else "x\ry"
    assert sorted(map(tuple, found)) == [("second", "2"), ("third", "3"), (value, "1")]


def test_a_cr_is_read_alike_beside_rows_that_span_lines(spark, tmp_path):
    for name, other in (("cut", "plain"), ("joined", '"two\nlines"')):
        write(tmp_path / name, "a.csv", "name,rank", ['"x\ry",1', "x\ry,2", f"{other},3"])
    rows = {}
    for name in ("cut", "joined"):
        raw = csv_files.read_raw(spark, discover(spark, [str(tmp_path / name / "*.csv")]))
        rows[name] = sorted(tuple(r)[:2] for r in raw.where("rank < 3").collect())
    assert rows["cut"] == rows["joined"] == [("x\ry", "1"), ("x\ry", "2")]


def test_rows_that_span_lines_are_read_and_parsed_once(spark, folder):
    (layout,) = [
        found
        for found in csv_files.layouts(spark, discover(spark, [str(folder)]))
        if found.way == csv_files.JOINED
    ]
    rows = csv_files.scan(spark, layout, [f"c{i}" for i in range(len(layout.headers))])
    plan = rows._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall("MapIn(?:Pandas|Arrow)", plan)) == 1
    assert plan.count("from_csv(") == 1


def test_lines_of_pieces_are_found_for_both_ways_to_begin():
    draw = random.Random(5)
    for _ in range(300):
        lines = [(draw.random() < 0.4, draw.random() < 0.5, draw.random() < 0.2) for _ in range(12)]
        cuts = sorted({0, 12, *(draw.randrange(13) for _ in range(3))})
        batches = [
            pa.RecordBatch.from_arrays(
                [
                    pa.array(["a.csv"] * (b - a)),
                    # two pieces of six lines each
                    pa.array([0 if i < 6 else 100 for i in range(a, b)], pa.int64()),
                    pa.array(range(a, b), pa.int64()),
                    *(pa.array([line[k] for line in lines[a:b]], pa.bool_()) for k in range(3)),
                ],
                names=["path", "block", "row", "opens", "stays", "blank"],
            )
            for a, b in zip(cuts, cuts[1:])
        ]
        found = [row for batch in spanning._piece_states(batches) for row in batch.to_pylist()]
        for piece, begin in zip(found, (0, 6), strict=True):
            for name, inside in (("outside", False), ("inside", True)):
                state, begun, head = inside, None, spanning._NEVER
                for i in range(begin, begin + 6):
                    if not state:
                        begun = i
                    opens, stays, _ = lines[i]
                    state = stays if state else opens
                    if not state and head == spanning._NEVER:
                        head = i
                assert piece[f"from_{name}"] == state
                assert piece[f"tail_{name}"] == (begun if state else None)
                if inside:
                    assert piece["head"] == head
        texts = [i for i in range(6) if not lines[i][2]]
        assert [p["header"] for p in found] == [texts[0] if texts else None, None]


def test_a_clean_file_can_be_read_by_several_tasks(spark, tmp_path):
    rows = spark.range(0, 3_000_000, 1, 1).select(F.md5(F.col("id").cast("string")).alias("text"))
    path = sinks.save_clean(rows, str(tmp_path / "clean"))
    read = spark.read.parquet(path)
    assert len(read.inputFiles()) == 1
    assert read.select(F.spark_partition_id().alias("task")).distinct().count() > 1


def test_a_preview_reads_its_file_once(spark, folder):
    for layout in csv_files.layouts(spark, discover(spark, [str(folder)])):
        names = [f"c{i}" for i in range(len(layout.headers))]
        raw = csv_files.scan(spark, layout, names, position=True)
        plan = sinks.first_rows(raw, 2)._jdf.queryExecution().executedPlan().toString()
        assert "WindowGroupLimit" in plan
        assert "LeftSemi" not in plan
        rows = sinks.first_rows(raw, 2).collect()
        everything = raw.collect()
        for file in {r["source_path"] for r in everything}:
            in_order = sorted(
                (r for r in everything if r["source_path"] == file),
                key=lambda r: (r["block_start"], r["row_order"]),
            )
            found = sorted((r for r in rows if r["source_path"] == file), key=lambda r: r["place"])
            assert [r["c2"] for r in found] == [r["c2"] for r in in_order[:2]]
