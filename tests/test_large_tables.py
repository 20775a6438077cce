"""What keeps work in step with the tables: raw files and stored totals."""

from __future__ import annotations

import datetime
import decimal
import glob
import os
import re
from collections import Counter

from pyspark.sql import functions as F

from checks import file_queries, loans, raw_files
from lendscope.model import LOAN_SCHEMA
from lendscope.operators import cleaning, kept_totals, layout
from lendscope.operators.sinks import TABLE_SCHEMA
from lendscope.plans.dashboard import dashboard, panel_lines
from lendscope.session import pieces_together, shared_root
from lendscope.sources import csv_files


def test_both_programs_are_written_from_loans_derived_once(spark, sf_dir, monkeypatch):
    derive = loans.derive
    either = F.udf(lambda: ("7A", "504")[os.urandom(1)[0] % 2]).asNondeterministic()

    def drawn(*given):
        return derive(*given).withColumn("program", either())

    monkeypatch.setattr(loans, "derive", drawn)
    folder = raw_files.write(spark, sf_dir, line_breaks=False)
    written = spark.read.option("header", True).csv(f"{folder}/*").select("L2LocID").distinct()
    assert written.count() == derive(spark, sf_dir, "loan_id").distinct().count()


def test_stored_totals_hold_lenders_of_industries_once(spark, tmp_path):
    n = 300
    row = {
        "as_of_date": datetime.date(2025, 12, 31),
        "jobs_supported": 1,
        **dict.fromkeys(
            ("loan_amount", "sba_guaranteed_approval", "charge_off_amount"), decimal.Decimal("1.50")
        ),
    }
    rows = [
        row
        | {
            "loan_row_id": i,
            "borrower_state": f"S{i % 2}",
            "approval_fiscal_year": 2000 + i % 3,
            "naics_code": f"11000{i % 5}",
            "naics_description": f"d{i}",
            "lender_name": f"l{i}",
            "loan_status": "EXEMPT",
            "program": "7A",
        }
        for i in range(n)
    ]
    assert {f.name for f in LOAN_SCHEMA} >= set(rows[0]) - {"loan_row_id"}
    table = spark.createDataFrame(
        [tuple(r.get(f.name) for f in TABLE_SCHEMA) for r in rows], TABLE_SCHEMA
    )
    path = str(tmp_path / "totals")
    kept_totals.write_totals(table, path)
    stored = spark.read.schema(kept_totals.totals_schema(table)).parquet(path)
    assert stored.agg(F.sum("total_loans")).head()[0] == n * len(kept_totals._cuts())
    # Four cuts with descriptions, four by lenders without industries, one with; the rest is small.
    assert stored.count() < 10 * n


def test_files_of_a_header_alone_do_not_fail_the_joined_scan(spark, sf_dir):
    setting, cost = "spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes"
    before = {name: spark.conf.get(name) for name in (setting, cost)}
    spark.conf.set(setting, "16k")
    spark.conf.set(cost, "16k")
    try:
        run, _ = file_queries.queries()["a4_text_scan_joined"]
        found = run(spark, sf_dir).head()
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    lines = loans.table(spark, sf_dir, "lineitem")
    assert found["row_count"] == lines.count() + lines.where("l_linenumber = 1").count()


def test_all_panels_together_read_the_kept_totals(spark, sf_dir):
    page = dashboard(loans.derive(spark, sf_dir))
    for together in (panel_lines(page), page.findings):
        plan = together._jdf.queryExecution().withCachedData().toString()
        # Before, all panels of a union but one added the loans up again.
        assert "InMemoryRelation" in plan and "lineitem" not in plan and "Expand" not in plan
    assert not panel_lines(page).isEmpty()
    page.release()
    assert not panel_lines(page).isEmpty()


def test_many_customers_meet_their_orders_first(spark, sf_dir):
    columns = ("loan_id", "program", "borrower_state", "lender_name", "naics_description")
    few = loans.derive(spark, sf_dir, *columns)
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "1")
    try:
        many = loans.derive(spark, sf_dir, *columns)
        plan = many._jdf.queryExecution().optimizedPlan().toString()
        assert many.exceptAll(few).isEmpty() and few.exceptAll(many).isEmpty()
    finally:
        spark.conf.set(setting, before)
    # The upper join comes first in a plan: no loan is looked up by its customer.
    joins = re.findall(r"Join LeftOuter, \((\w+)#", plan)
    assert joins.index("l_orderkey") < joins.index("o_custkey")


def test_the_cut_scan_looks_for_layouts_once(spark, sf_dir, monkeypatch):
    asked, layouts = [], csv_files.layouts
    monkeypatch.setattr(csv_files, "layouts", lambda *given: asked.append(1) or layouts(*given))
    run, _ = file_queries.queries()["a4_text_scan_cut"]
    lines = loans.table(spark, sf_dir, "lineitem")
    assert run(spark, sf_dir).head()["row_count"] == (
        lines.count() + lines.where("l_linenumber = 1").count()
    )
    assert len(asked) == 1


def test_bounds_of_the_curve_come_from_one_reading(spark):
    read = spark.sparkContext.accumulator(0)

    def seen(value):
        read.add(1)
        return value

    codes = spark.range(500).select(F.udf(seen)(F.col("id").cast("string")).alias("code"))
    assert len(layout.class_bounds(codes, ("code",))["code"].bounds) == 63
    assert read.value == 500


def _scratch(spark, label):
    """Folders of scratch of this label."""
    return set(glob.glob(f"{shared_root(spark)}/{label}-*"))


def test_small_pieces_share_tasks(spark, tmp_path):
    path = tmp_path / "lines"
    path.write_text("".join(f"line {i}\n" for i in range(20_000)))
    settings = {
        "spark.sql.files.maxPartitionBytes": "1k", "spark.sql.files.openCostInBytes": "1k"
    }
    before = {name: spark.conf.get(name) for name in settings}
    most = 4 * spark.sparkContext.defaultParallelism
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        with pieces_together(spark, path.stat().st_size):
            lines = spark.read.text(str(path)).select("_metadata.file_block_start", "value")
            # Tasks are not filled to the brim.
            assert lines.rdd.getNumPartitions() <= 1.25 * most
            assert lines.select("file_block_start").distinct().count() > 2 * most
            assert lines.select("value").distinct().count() == 20_000
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    assert spark.conf.get("spark.sql.files.maxPartitionNum", None) is None


def test_scans_of_small_pieces_bound_their_tasks(spark, sf_dir, monkeypatch):
    asked, read_raw = [], csv_files.read_raw

    def read(*given, **named):
        asked.append(spark.conf.get("spark.sql.files.maxPartitionNum", None))
        return read_raw(*given, **named)

    monkeypatch.setattr(csv_files, "read_raw", read)
    for way in ("cut", "joined"):
        file_queries.queries()[f"a4_text_scan_{way}"][0](spark, sf_dir)
    assert asked == [str(4 * spark.sparkContext.defaultParallelism)] * 2


def test_stored_loans_go_when_raw_files_are_written(spark, sf_dir):
    before = _scratch(spark, "raw-loans")
    raw_files.write(spark, sf_dir)
    assert _scratch(spark, "raw-loans") == before


def test_scratch_of_totals_and_bounds_goes(spark, sf_dir, tmp_path):
    table = spark.createDataFrame([], TABLE_SCHEMA)
    before = _scratch(spark, "base-totals"), _scratch(spark, "curve-values")
    kept_totals.write_totals(table, str(tmp_path / "totals"))
    layout.class_bounds(loans.derive(spark, sf_dir, *layout.CURVE_COLUMNS))
    assert (_scratch(spark, "base-totals"), _scratch(spark, "curve-values")) == before


def test_rows_are_packed_for_the_shuffle_and_come_back(spark):
    odd = [None, "", " ", "\x1e", "\x1f", "\x1em", "\x1eb", "a\x1fb", "\x1f\x1e\x1f", "x,\"\n"]
    rows = [(a, n, b) for a in odd for b in odd for n in (1, None)]
    made = spark.createDataFrame(rows * 2 + rows[:7], "`a.b` string, n int, c string")
    counted = cleaning.copy_counts(made)
    expected = Counter(rows * 2 + rows[:7])
    assert {tuple(r[:3]): r[3] for r in counted.collect()} == expected
    assert counted.count() == len(rows)
    plan = counted._jdf.queryExecution().optimizedPlan().toString()
    assert re.search(r"Aggregate \[packed_cells_#\d+, n#\d+\]", plan)


def test_the_curve_derives_loans_once(spark, sf_dir, monkeypatch):
    read, derive = spark.sparkContext.accumulator(0), loans.derive

    def seen(value):
        read.add(1)
        return value

    def counted(*given):
        state = F.udf(seen)(F.coalesce("borrower_state", F.lit("-")))
        return derive(*given).withColumn("borrower_state", F.nullif(state, F.lit("-")))

    monkeypatch.setattr(loans, "derive", counted)
    before = _scratch(spark, "curve-loans")
    found = file_queries.queries()["a13_filters_on_curve"][0](spark, sf_dir)
    rows = loans.table(spark, sf_dir, "lineitem").count()
    assert found.count() == 4 and read.value == rows
    assert _scratch(spark, "curve-loans") == before
