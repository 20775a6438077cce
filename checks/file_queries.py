"""Raw files, cleaning, loading and jobs (A, B1-B10, C5, C6, D20, H1-H4)."""

from __future__ import annotations

from collections.abc import Callable
from functools import cache

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from checks import loans, raw_files
from checks.measure_queries import (
    FOUR,
    FUNDING,
    QUESTIONS,
    SECTOR,
    VIEW_QUESTIONS,
    Query,
    over_loans,
)
from checks.results import plain
from lendscope.functions import cells
from lendscope.model import DATE_COLUMNS, LOAN_COLUMNS, LOAN_TYPES, ROW_KEY
from lendscope.operators import (
    adhoc,
    cleaning,
    conform,
    layout,
    measures,
    naming,
    profiling,
    sinks,
    views,
)
from lendscope.operators.filters import LoanFilter
from lendscope.plans import jobs
from lendscope.session import (
    SCRATCH_OPTIONS,
    discard,
    free_shuffles,
    pieces_together,
    scratch_path,
    sized_shuffles,
)
from lendscope.sources import csv_files
from lendscope.sources.discover import discover, require
from lendscope.streaming.chunked_load import load_in_chunks

# The raw rows: a loan of line number 1 is there twice.  Of six ways to write an
# unknown cell the sixth, three spaces, is no NA token.
_RAW = (
    f"WITH loans AS ({loans.SQL}), copies AS (SELECT 1 AS copy UNION ALL SELECT 2), "
    "raw AS (SELECT loans.* FROM loans JOIN copies ON copy = 1 OR mod(loan_id, 10) = 1) "
)
_EXPECTED = f"WITH cleaned AS ({raw_files.EXPECTED}) "
_READ_AS_NULL = "mod(loan_id, 6) <> 5"


# Raw files and what is made of them are written once per application; several
# queries then read them.
@cache
def _folder(application: str, spark: SparkSession, sf_dir: str) -> str:
    return raw_files.write(spark, sf_dir)


@cache
def _clean_result(application: str, spark: SparkSession, sf_dir: str) -> jobs.CleanResult:
    return jobs.clean_job(spark, candidates(spark, sf_dir), scratch_path(spark, "clean"))


def _clean_path(application: str, spark: SparkSession, sf_dir: str) -> str:
    return _clean_result(application, spark, sf_dir).path


@cache
def _table_path(application: str, spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "loans")
    with sized_shuffles(spark, loans.joined_bytes(spark, sf_dir)):
        sinks.write_table_files(loans.derive(spark, sf_dir), path)
    return path


def candidates(spark: SparkSession, sf_dir: str) -> list[str]:
    """Where to look for raw files: a place without any, then the right one."""
    folder = _folder(spark.sparkContext.applicationId, spark, sf_dir)
    return [f"{folder}/none/*.csv", f"{folder}/program_*"]


def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cleaned dataset."""
    path = _clean_path(spark.sparkContext.applicationId, spark, sf_dir)
    return sinks.read_clean(spark, path)


def loaded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The loans table as loaded."""
    path = _table_path(spark.sparkContext.applicationId, spark, sf_dir)
    return sinks.read_table_files(spark, path)


def _files(spark: SparkSession, sf_dir: str):
    where = candidates(spark, sf_dir)
    return require(discover(spark, where), where)


_TEXTS = [
    "program", "borrower_state", "lender_name", "naics_code", "naics_description", "loan_status",
    "jobs_supported",
]


def _counts(columns: list[str]) -> list[Column]:
    return [F.count(c).alias(c) for c in columns]


def _raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = csv_files.read_raw(spark, _files(spark, sf_dir))
    return raw.agg(F.count(F.lit(1)).alias("row_count"), *_counts(_TEXTS))


def _scan_in_pieces(way: str) -> Callable[[SparkSession, str], DataFrame]:
    """The scan of files that are read in one way, cut into small pieces."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = raw_files.write(spark, sf_dir, line_breaks=way == csv_files.JOINED)
        setting = "spark.sql.files.maxPartitionBytes"
        before = spark.conf.get(setting)
        spark.conf.set(setting, "64k")
        try:
            files = discover(spark, [f"{folder}/program_*"])
            with pieces_together(spark, sum(f.length for f in files)):
                # A file of a header row alone has nothing to join; no row is read the other way.
                known = csv_files.layouts(spark, files)
                for layout in known:
                    assert layout.way == way or csv_files.scan(spark, layout, layout.headers).isEmpty()
                raw = csv_files.read_raw(spark, files, known=known)
                counts = raw.agg(F.count(F.lit(1)).alias("row_count"), *_counts(_TEXTS))
                # Computed here, while pieces are small: one row of counts.
                return spark.createDataFrame(counts.collect(), counts.schema)
        finally:
            spark.conf.set(setting, before)

    return run


def _read_sql(column: str) -> str:
    return f"COUNT(CASE WHEN {column} IS NOT NULL OR NOT {_READ_AS_NULL} THEN 1 END) AS {column}"


def _typed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All files with inferred types: type and missing values per column."""
    typed = csv_files.read_typed(spark, _files(spark, sf_dir))
    return profiling.column_profile(typed.drop("source_file"))


# Raw header and type of each column, by program.  A column with a word, a sign or
# three spaces in it stays text.
_HEADERS = {
    "7A": {
        "as_of_date": "AsOfDate",
        "program": "Program",
        "loan_id": "L2LocID",
        "borrower_name": "BorrName",
        "borrower_state": "BorrState",
        "lender_name": "BankName",
        "loan_amount": "GrossApproval",
        "approval_date": "ApprovalDate",
        "approval_fiscal_year": "ApprovalFiscalYear",
        "naics_code": "NAICSCode",
        "naics_description": "NAICSDescription",
        "loan_status": "LoanStatus",
        "charge_off_amount": "GrossChargeOffAmount",
        "jobs_supported": "JobsSupported",
    },
    "504": {
        "as_of_date": "AsOfDate",
        "program": "Program",
        "loan_id": "L2LocID",
        "borrower_name": "BorrName",
        "borrower_state": "BORRSTATE",
        "lender_name": "BankName",
        "third_party_lender_name": "ThirdPartyLender_Name",
        "cdc_name": "CDC_Name",
        "loan_amount": "Gross Approval",
        "approval_date": "ApprovalDate",
        "approval_fiscal_year": "ApprovalFiscalYear",
        "naics_code": "NAICSCode",
        "naics_description": "NAICSDescription",
        "loan_status": "LoanStatus",
        "charge_off_amount": "GrossChargeOffAmount",
        "jobs_supported": "JobsSupported",
    },
}
_TYPED = {"loan_id": "bigint", "approval_fiscal_year": "double"}


def _missing_sql(column: str) -> str:
    """How many cells of a raw column read as null, in raw text; none for one made full.

    A single space is an NA token of the cleaning scan only.
    """
    if column == "borrower_name":
        return "0 * COUNT(*)"
    known = f"{column} IS NOT NULL"
    if column == "loan_amount":
        known += " OR mod(loan_id, 71) = 0"
    missing = f"NOT ({known}) AND mod(loan_id, 6) NOT IN (1, 5)"
    if column not in _HEADERS["7A"]:
        missing = f"program = '7A' OR ({missing})"
    return f"COUNT(CASE WHEN {missing} THEN 1 END)"


def _typed_sql() -> str:
    lines = [
        f"SELECT '{c}' AS column_name, '{_TYPED.get(c, 'string')}' AS dtype, "
        f"{_missing_sql(c)} AS missing_values FROM raw"
        for c in _HEADERS["504"]
    ]
    return _RAW + " UNION ALL ".join(lines)


def _profile_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = jobs.profile_job(
        spark, candidates(spark, sf_dir), scratch_path(spark, "preview"), 1000
    )
    program = F.regexp_extract("source_path", r"program_(\w+)/", 1).alias("program")
    return report.groupBy(
        program, "column_count", "column_position", "column_name", "dtype"
    ).agg(F.sum("row_count").alias("row_count"), F.sum("missing_values").alias("missing_values"))


def _profile_sql() -> str:
    lines = [
        f"SELECT '{program}' AS program, {len(headers)} AS column_count, {i} AS column_position, "
        f"'{header}' AS column_name, '{_TYPED.get(c, 'string')}' AS dtype, COUNT(*) AS row_count, "
        f"{_missing_sql(c)} AS missing_values FROM raw WHERE program = '{program}'"
        for program, headers in _HEADERS.items()
        for i, (c, header) in enumerate(headers.items())
    ]
    return _RAW + " UNION ALL ".join(lines)


_PREVIEW_ROWS = 1000


def _preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the written previews hold, per program, after writing them twice.

    Rows are taken from the first of each file, so which loans are in a preview
    depends on the files; that each is a whole prefix of its file is seen from the
    scan, and the files' loans from the tables.
    """
    folder = scratch_path(spark, "preview")
    for _ in range(2):
        jobs.profile_job(spark, candidates(spark, sf_dir), folder, _PREVIEW_ROWS)
    written = (
        spark.read.options(header=True, quote='"', escape='"', multiLine=True)
        .csv(folder)
        .select(cells.strip(F.col("Program")).alias("program"), F.col("L2LocID").alias("loan_id"), "preview")
    )
    scanned = []
    for layout in csv_files.layouts(spark, _files(spark, sf_dir)):
        raw = csv_files.scan(spark, layout, layout.headers, position=True)
        scanned.append(
            raw.select(
                "L2LocID", "source_path", "block_start", "row_order",
                sinks.preview_name("source_path").alias("preview"),
            )
        )
    in_file = Window.partitionBy("source_path").orderBy("block_start", "row_order")
    heads = (
        csv_files.union_by_name(scanned)
        .withColumn("place", F.row_number().over(in_file))
        .where(F.col("place") <= _PREVIEW_ROWS)
        .groupBy("preview")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(F.hash("L2LocID").cast("long")).alias("mark"))
    )
    found = written.groupBy("preview").agg(
        F.max("program").alias("program"),
        F.count(F.lit(1)).alias("rows_written"),
        F.sum(F.hash("loan_id").cast("long")).alias("written_mark"),
    )
    return (
        found.join(heads, "preview", "full")
        .groupBy("program")
        .agg(
            F.bool_and(
                (F.col("rows_written") == F.col("n")) & (F.col("written_mark") == F.col("mark"))
            ).alias("heads_of_files"),
            (F.max("rows_written") <= _PREVIEW_ROWS).alias("within_limit"),
        )
    )


def _clean_rows(df: DataFrame) -> DataFrame:
    return plain(conform.conform(df).select(*_CLEANED))


_CLEANED = [
    "loan_id", "program", "borrower_state", "lender_name", "naics_code", "naics_description",
    "loan_amount", "charge_off_amount", "jobs_supported", "approval_date", "approval_fiscal_year",
    "loan_status", "as_of_date", "borrower_name",
]
_CLEANED_SQL = ", ".join(
    f"CAST({c} AS VARCHAR) AS {c}"
    if c in DATE_COLUMNS
    else f"CAST({c} AS DOUBLE) AS {c}"
    if c in ("loan_amount", "charge_off_amount")
    else c
    for c in _CLEANED
)


def _csv_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.save_clean(cleaned(spark, sf_dir), scratch_path(spark, "clean-csv"), "csv")
    return _clean_rows(sinks.read_clean(spark, path, "csv"))


def _failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_result(spark.sparkContext.applicationId, spark, sf_dir).coercion_failures


def _failures_sql() -> str:
    failed = {
        "loan_amount": "mod(loan_id, 71) = 0",
        "approval_date": "mod(loan_id, 79) = 0",
    }
    symbols = {"loan_amount": "mod(loan_id, 142) = 0"}
    counted = [
        "loan_amount", "approval_fiscal_year", "charge_off_amount", "jobs_supported",
        "as_of_date", "approval_date",
    ]
    return _RAW + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, "
        f"COUNT(CASE WHEN {failed.get(c, 'FALSE')} THEN 1 END) AS failed_values, "
        f"COUNT(CASE WHEN {symbols.get(c, 'FALSE')} THEN 1 END) AS failed_with_symbols FROM raw"
        for c in counted
    )


def _run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _clean_result(spark.sparkContext.applicationId, spark, sf_dir).summary


def _chunked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean files loaded one at a time, then counted per state."""
    source = _clean_path(spark.sparkContext.applicationId, spark, sf_dir)
    schema = cleaned(spark, sf_dir).schema
    target, notes = scratch_path(spark, "chunked"), scratch_path(spark, "notes")
    for _ in range(2):  # a second run finds nothing new
        load_in_chunks(spark, source, schema, target, notes, files_per_chunk=1)
    loaded_rows = sinks.read_table_files(spark, target)
    keys = loaded_rows.agg(F.count_distinct(ROW_KEY), F.count(F.lit(1))).head()
    return plain(measures.state_view(loaded_rows)).withColumns(
        {"distinct_keys": F.lit(keys[0]), "all_rows": F.lit(keys[1])}
    )


_PER_STATE = f"SELECT borrower_state, {FOUR} FROM {{}} WHERE borrower_state IS NOT NULL GROUP BY 1"


def _report(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _table_path(spark.sparkContext.applicationId, spark, sf_dir)
    stored = spark.read.schema(sinks.TABLE_SCHEMA).parquet(path)
    return (
        sinks.load_report(stored)
        .groupBy(sinks.YEAR)
        .agg(
            F.sum("chunk_rows").alias("year_rows"),
            F.max("rows_loaded").alias("rows_loaded"),
            F.max("total_rows").alias("total_rows"),
        )
    )


def _row_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = loaded(spark, sf_dir).select(ROW_KEY)
    repeated = keys.groupBy(ROW_KEY).count()
    return repeated.agg(
        F.sum("count").alias("row_count"),
        F.count(F.lit(1)).alias("distinct_keys"),
        (F.min(ROW_KEY) >= 1).alias("from_one"),
    )


def _contiguous_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key figures of the table as loaded at once and as loaded file by file."""
    batch = loaded(spark, sf_dir)  # first, so that its shuffles are gone when raw files are there
    source = _clean_path(spark.sparkContext.applicationId, spark, sf_dir)
    target, notes = scratch_path(spark, "chunked"), scratch_path(spark, "notes")
    load_in_chunks(
        spark, source, cleaned(spark, sf_dir).schema, target, notes, files_per_chunk=1
    )
    tables = {"batch": batch, "chunks": sinks.read_table_files(spark, target)}
    figures = [
        sinks.with_contiguous_keys(table)
        .groupBy(ROW_KEY)
        .count()
        .agg(
            F.lit(name).alias("load"),
            F.sum("count").alias("row_count"),
            F.count(F.lit(1)).alias("distinct_keys"),
            F.min(ROW_KEY).alias("first_key"),
            F.max(ROW_KEY).alias("last_key"),
        )
        for name, table in tables.items()
    ]
    return figures[0].unionByName(figures[1])


def _over_views(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        views.create_views(loans.derive(spark, sf_dir))
        return plain(spark.table(name))

    return run


def _with_parameters(spark: SparkSession, sf_dir: str) -> DataFrame:
    loans.derive(spark, sf_dir).createOrReplaceTempView("derived_loans")
    query = (
        "SELECT borrower_state, naics_code, COUNT(*) AS total_loans, "
        "SUM(COALESCE(loan_amount, 0)) AS total_funding FROM derived_loans "
        "WHERE borrower_state = :state AND approval_fiscal_year = :year "
        "GROUP BY borrower_state, naics_code"
    )
    return plain(adhoc.read_sql(spark, query, {"state": "NATION_3", "year": 1998}))


def _standardized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans under raw headers of many spellings, given their table names again."""
    headers = {
        "loan_id": "L2LocID",
        "program": " program ",
        "borrower_state": "Borr State",
        "loan_amount": "GROSS_APPROVAL",
        "jobs_supported": "jobsSupported",
        "cdc_name": "CDC_Name",
    }
    fact = loans.derive(spark, sf_dir, *headers)
    return plain(naming.standardize_column_names(fact.withColumnsRenamed(headers)))


def _trimmed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with white space of many scripts put around and taken off again."""
    around = F.lit("\t   　\u000b")
    documents = loans.table(spark, sf_dir, "documents").select("doc_id", "text")
    padded = documents.withColumn("text", F.concat(around, "text", around))
    texts = cleaning.trim_text(padded)
    return texts.select("doc_id", F.md5("text").alias("digest"), F.length("text").alias("length"))


def _blanks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loan texts in which blanks of several kinds stand for unknown values."""
    number = F.col("loan_id")
    blank = F.element_at(
        F.array(*[F.lit(t) for t in ("", "  ", "\t", " ")]), (number % 4 + 1).cast("int")
    )
    columns = ["borrower_state", "loan_status", "lender_name"]
    fact = loans.derive(spark, sf_dir, "loan_id", *columns)
    filled = fact.withColumns({c: F.coalesce(c, blank) for c in columns})
    return cleaning.blank_to_null(filled).groupBy(*columns).agg(
        F.count(F.lit(1)).alias("total_loans")
    )


def _lenders(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = loans.derive(spark, sf_dir, "lender_name", "third_party_lender_name", "cdc_name")
    unified = cleaning.unify_lender(fact)
    return unified.groupBy("lender_name").agg(F.count(F.lit(1)).alias("total_loans"))


# Untidy numbers and dates per order line, written alike in both dialects.
_AMOUNT = "CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR(20))"
_NUMBER_TEXT = (
    "CASE mod(l_partkey, 8) "
    f"WHEN 0 THEN concat('$', {_AMOUNT}) "
    f"WHEN 1 THEN concat('-', {_AMOUNT}) "
    "WHEN 2 THEN concat(CAST(CAST(l_quantity AS INT) AS VARCHAR(9)), '%') "
    "WHEN 3 THEN concat(CAST(CAST(l_quantity AS INT) AS VARCHAR(9)), ',', '250.0') "
    f"WHEN 4 THEN concat('(', {_AMOUNT}, ')') "
    "WHEN 5 THEN 'N.A.' "
    "WHEN 6 THEN concat(CAST(l_linenumber AS VARCHAR(9)), 'e3') "
    f"ELSE {_AMOUNT} END"
)
_DAY = "CAST(l_shipdate AS DATE)"
_MONTH_FIRST = (
    f"concat(CAST(month({_DAY}) AS VARCHAR(2)), '/', CAST(day({_DAY}) AS VARCHAR(2)), '/', "
    f"CAST(year({_DAY}) AS VARCHAR(4)))"
)
_DATE_TEXT = (
    "CASE mod(l_partkey, 5) "
    f"WHEN 0 THEN CAST({_DAY} AS VARCHAR(10)) "
    "WHEN 1 THEN concat('13/', CAST(l_linenumber AS VARCHAR(9)), '/2001') "
    f"WHEN 2 THEN concat({_MONTH_FIRST}, ' 00:00') "
    f"ELSE {_MONTH_FIRST} END"
)


def _numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.expr(_NUMBER_TEXT)
    lines = loans.table(spark, sf_dir, "lineitem")
    typed = cleaning.coerce_numbers(
        lines.select("l_linenumber", text.alias("loan_amount"), text.alias("jobs_supported"))
    )
    return plain(
        typed.groupBy("l_linenumber").agg(
            F.count("loan_amount").alias("amounts"),
            F.sum("loan_amount").alias("amount_sum"),
            F.count("jobs_supported").alias("whole_numbers"),
            F.sum("jobs_supported").alias("whole_sum"),
        )
    )


_NUMBERS_SQL = (
    "WITH typed AS (SELECT l_linenumber, TRY_CAST(regexp_replace("
    f"{_NUMBER_TEXT}, '[$,%]', '', 'g') AS DECIMAL(18,2)) AS amount FROM lineitem) "
    "SELECT l_linenumber, COUNT(amount) AS amounts, CAST(SUM(amount) AS DOUBLE) AS amount_sum, "
    "COUNT(CASE WHEN amount % 1 = 0 THEN 1 END) AS whole_numbers, "
    "CAST(SUM(CASE WHEN amount % 1 = 0 THEN amount END) AS BIGINT) AS whole_sum "
    "FROM typed GROUP BY l_linenumber"
)


def _dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = loans.table(spark, sf_dir, "lineitem")
    typed = cleaning.coerce_dates(
        lines.select("l_linenumber", F.expr(_DATE_TEXT).alias("approval_date"))
    )
    return plain(typed.groupBy("approval_date").agg(F.count(F.lit(1)).alias("line_count")))


_DATES_SQL = (
    f"WITH texts AS (SELECT {_DATE_TEXT} AS text FROM lineitem) "
    "SELECT CAST(CASE WHEN regexp_full_match(text, '[0-9]{4}-[0-9]{2}-[0-9]{2}') "
    "THEN CAST(try_strptime(text, '%Y-%m-%d') AS DATE) "
    "WHEN regexp_full_match(text, '[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}') "
    "THEN CAST(try_strptime(text, '%m/%d/%Y') AS DATE) END AS VARCHAR) AS approval_date, "
    "COUNT(*) AS line_count FROM texts GROUP BY 1"
)


def _conformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = loans.derive(spark, sf_dir).withColumn("not_in_table", F.lit(1))
    return profiling.column_profile(conform.conform(extra))


def _conformed_sql() -> str:
    return over_loans(
        " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, '{LOAN_TYPES[c].simpleString()}' AS dtype, "
            f"COUNT(*) - {f'COUNT({c})' if c in loans.COLUMNS else '0'} AS missing_values "
            "FROM loans"
            for c in LOAN_COLUMNS
        )
    )


def _prepared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loans as text, as a text file gives them, made ready for the table."""
    fact = loans.derive(spark, sf_dir)
    texts = fact.select(*[F.coalesce(F.col(c).cast("string"), F.lit("NULL")).alias(c) for c in fact.columns])
    return plain(
        conform.prepare(texts)
        .groupBy("borrower_state", "approval_date")
        .agg(
            F.count("loan_amount").alias("amounts"),
            F.sum("loan_amount").alias("amount_sum"),
            F.sum("jobs_supported").alias("jobs"),
            F.sum("loan_id").alias("id_sum"),
        )
    )


_PREPARED_SQL = (
    "SELECT borrower_state, CAST(approval_date AS VARCHAR) AS approval_date, "
    "COUNT(loan_amount) AS amounts, CAST(SUM(loan_amount) AS DOUBLE) AS amount_sum, "
    "CAST(SUM(jobs_supported) AS BIGINT) AS jobs, CAST(SUM(loan_id) AS BIGINT) AS id_sum "
    "FROM loans GROUP BY 1, 2"
)


def _sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plain(
        measures.totals(loans.derive(spark, sf_dir, "naics_code", "loan_amount", "jobs_supported",
                                     "charge_off_amount", "sba_guaranteed_approval"), "sector")
        .select("sector", "total_loans", "total_funding")
    )


# Small pages let a small table show what is skipped.  The year and state layout skips nothing
# under a status filter; the shares are of all rows, a third of which have such a status.
_SMALL_PAGES = {
    "parquet.block.size": "65536",
    "parquet.page.size.row.check.min": "50",
    "parquet.page.row.count.limit": "50",
}
_ON_CURVE = {
    "status": ("loan_status = 'P I F'", 0.6),
    "industry": ("naics_code = '110000'", 0.35),
    "state": ("borrower_state = 'NATION_3'", 0.6),
    "state and status": ("borrower_state = 'NATION_3' AND loan_status = 'CHGOFF'", 0.35),
}


def _along_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "loans-on-curve")
    options = _SMALL_PAGES | layout.FILE_OPTIONS
    # The loans are stored, so that the joins are done once and their shuffles are gone when
    # the rows are laid out.
    stored, fact = scratch_path(spark, "curve-loans"), loans.derive(spark, sf_dir)
    with sized_shuffles(spark, loans.joined_bytes(spark, sf_dir)):
        fact.write.options(**SCRATCH_OPTIONS).parquet(stored)
        free_shuffles(spark)
        derived = spark.read.schema(fact.schema).parquet(stored)
        sinks.write_table_files(derived, path, layout.along_curve, **options)
    discard(spark, stored)
    table = sinks.read_table_files(spark, path)
    every = table.count()
    found = []
    for name, (condition, share) in _ON_CURVE.items():
        counted = table.where(condition).agg(
            F.count(F.lit(1)).alias("n"), F.sum("loan_amount").cast("double").alias("amount")
        )
        row = counted.collect()[0]
        found.append((name, row["n"], row["amount"], layout.rows_read(counted) < share * every))
    return spark.createDataFrame(
        found, "chosen string, total_loans long, amount double, most_rows_skipped boolean"
    )


def _curve_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS chosen, COUNT(*) AS total_loans, CAST(SUM(loan_amount) AS DOUBLE) "
        f"AS amount, TRUE AS most_rows_skipped FROM loans WHERE {condition}"
        for name, (condition, _) in _ON_CURVE.items()
    )


def queries() -> dict[str, Query]:
    """All of them, by name."""
    cleaned_sql = _EXPECTED + f"SELECT {_CLEANED_SQL} FROM cleaned"
    in_1998 = QUESTIONS["d7_state_funding"].sql("approval_fiscal_year = 1998")
    found: dict[str, Query] = {
        "a1_discover": (
            lambda spark, sf_dir: spark.read.text([f.path for f in _files(spark, sf_dir)])
            .where(F.col("value").startswith("AsOfDate,"))
            .agg(F.countDistinct("value").alias("header_rows")),
            "SELECT COUNT(DISTINCT CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') "
            "THEN '504' ELSE '7A' END) AS header_rows FROM lineitem "
            "LEFT JOIN orders ON l_orderkey = o_orderkey",
        ),
        "a3_typed_scan": (_typed_scan, _typed_sql()),
        "a4_text_scan": (
            _raw_scan,
            _RAW + "SELECT COUNT(*) AS row_count, " + ", ".join(map(_read_sql, _TEXTS)) + " FROM raw",
        ),
        **{
            f"a4_text_scan_{way}": (
                _scan_in_pieces(way),
                _RAW
                + "SELECT COUNT(*) AS row_count, "
                + ", ".join(map(_read_sql, _TEXTS))
                + " FROM raw",
            )
            for way in (csv_files.CUT, csv_files.JOINED)
        },
        "a5_source_file": (
            lambda spark, sf_dir: csv_files.read_raw(spark, _files(spark, sf_dir))
            .groupBy(cells.strip(F.col("program")).alias("program"))
            .agg(
                F.count("source_file").alias("rows_with_file"),
                F.bool_and(F.endswith("source_file", F.lit(".csv"))).alias("is_file_name"),
            ),
            _RAW + "SELECT program, COUNT(*) AS rows_with_file, TRUE AS is_file_name "
            "FROM raw GROUP BY program",
        ),
        "a7_preview": (
            _preview,
            _RAW + "SELECT DISTINCT program, TRUE AS heads_of_files, TRUE AS within_limit FROM raw",
        ),
        "a8_clean_csv_round_trip": (_csv_round_trip, cleaned_sql),
        "a9_chunked_load": (
            _chunked,
            _EXPECTED
            + "SELECT *, (SELECT COUNT(*) FROM cleaned) AS distinct_keys, "
            "(SELECT COUNT(*) FROM cleaned) AS all_rows FROM ("
            + _PER_STATE.format("cleaned")
            + ") AS per_state",
        ),
        "a10_source_rows": (
            lambda spark, sf_dir: profiling.row_count(
                csv_files.read_raw(spark, _files(spark, sf_dir))
            ),
            _RAW + "SELECT COUNT(*) AS row_count FROM raw",
        ),
        "a12_loaded_table": (
            lambda spark, sf_dir: plain(
                loaded(spark, sf_dir)
                .groupBy("approval_fiscal_year", "borrower_state", "program")
                .agg(F.count(F.lit(1)).alias("total_loans"), F.sum("loan_amount").alias("amount"))
            ),
            over_loans(
                "SELECT approval_fiscal_year, borrower_state, program, COUNT(*) AS total_loans, "
                "CAST(SUM(loan_amount) AS DOUBLE) AS amount FROM loans GROUP BY 1, 2, 3"
            ),
        ),
        "a13_filter_on_layout": (
            lambda spark, sf_dir: plain(
                measures.state_funding(loaded(spark, sf_dir), LoanFilter(fiscal_year=1998))
            ),
            over_loans(in_1998),
        ),
        "a13_filters_on_curve": (_along_curve, over_loans(_curve_sql())),
        "a14_row_key": (
            _row_keys,
            over_loans(
                "SELECT COUNT(*) AS row_count, COUNT(*) AS distinct_keys, TRUE AS from_one "
                "FROM loans"
            ),
        ),
        "a14_contiguous_keys": (
            _contiguous_keys,
            f"WITH loans AS ({loans.SQL}), cleaned AS ({raw_files.EXPECTED}) "
            "SELECT 'batch' AS load, COUNT(*) AS row_count, COUNT(*) AS distinct_keys, "
            "CAST(1 AS BIGINT) AS first_key, COUNT(*) AS last_key FROM loans UNION ALL "
            "SELECT 'chunks', COUNT(*), COUNT(*), 1, COUNT(*) FROM cleaned",
        ),
        "a15_load_report": (
            _report,
            over_loans(
                "SELECT approval_fiscal_year, COUNT(*) AS year_rows, "
                "CAST(SUM(COUNT(*)) OVER (ORDER BY approval_fiscal_year) AS BIGINT) AS rows_loaded, "
                "CAST(SUM(COUNT(*)) OVER () AS BIGINT) AS total_rows "
                "FROM loans GROUP BY approval_fiscal_year"
            ),
        ),
        "a18_bound_parameters": (
            _with_parameters,
            over_loans(
                f"SELECT borrower_state, naics_code, COUNT(*) AS total_loans, {FUNDING} "
                "AS total_funding FROM loans WHERE borrower_state = 'NATION_3' "
                "AND approval_fiscal_year = 1998 GROUP BY 1, 2"
            ),
        ),
        "b2_standardize_names": (
            _standardized,
            over_loans(
                "SELECT loan_id, program, borrower_state, CAST(loan_amount AS DOUBLE) AS "
                "loan_amount, jobs_supported, cdc_name FROM loans"
            ),
        ),
        "b3_trim_documents": (
            _trimmed,
            "WITH stripped AS (SELECT doc_id, trim(text, chr(9)||chr(10)||chr(11)||chr(12)||"
            "chr(13)||chr(28)||chr(29)||chr(30)||chr(31)||chr(32)||chr(133)||chr(160)||chr(5760)||"
            "chr(8192)||chr(8193)||chr(8194)||chr(8195)||chr(8196)||chr(8197)||chr(8198)||"
            "chr(8199)||chr(8200)||chr(8201)||chr(8202)||chr(8232)||chr(8233)||chr(8239)||"
            "chr(8287)||chr(12288)) AS text FROM documents) "
            "SELECT doc_id, md5(text) AS digest, length(text) AS length FROM stripped",
        ),
        "b4_blank_to_null": (
            _blanks,
            over_loans(
                "SELECT borrower_state, loan_status, lender_name, COUNT(*) AS total_loans "
                "FROM loans GROUP BY 1, 2, 3"
            ),
        ),
        "b5_unified_lender": (
            _lenders,
            over_loans(
                "SELECT coalesce(lender_name, third_party_lender_name, cdc_name) AS lender_name, "
                "COUNT(*) AS total_loans FROM loans GROUP BY 1"
            ),
        ),
        "b6_b7_numbers": (_numbers, _NUMBERS_SQL),
        "b8_dates": (_dates, _DATES_SQL),
        "b9_prepare_for_load": (_prepared, over_loans(_PREPARED_SQL)),
        "b10_conform": (_conformed, _conformed_sql()),
        "b11_sectors": (
            _sectors,
            over_loans(
                f"SELECT {SECTOR} AS sector, COUNT(*) AS total_loans, {FUNDING} AS total_funding "
                "FROM loans GROUP BY 1"
            ),
        ),
        "c5_c6_coercion_failures": (_failures, _failures_sql()),
        "d19_run_summary_of_files": (
            _run_summary,
            _RAW + "SELECT (SELECT COUNT(*) FROM loans) AS row_count, 17 AS column_count, "
            "COUNT(*) - (SELECT COUNT(*) FROM loans) AS duplicate_rows_removed FROM raw",
        ),
        "h1_profile_files": (_profile_job, _profile_sql()),
        "h2_clean_files": (lambda spark, sf_dir: _clean_rows(cleaned(spark, sf_dir)), cleaned_sql),
        "h3_load_clean": (_loaded_clean, _EXPECTED + _PER_STATE.format("cleaned")),
        "h3_load_clean_csv": (_loaded_csv, _EXPECTED + _PER_STATE.format("cleaned")),
        "h4_view_job": (_viewed, _EXPECTED + _PER_STATE.format("cleaned")),
        "a16_existence": (
            _existence,
            _RAW + "SELECT TRUE AS there, FALSE AS not_there, COUNT(*) > 0 AS has_rows, "
            "COUNT(*) < 0 AS none_has_rows FROM raw",
        ),
    }
    over = {
        "vw_state_funding": "d3_state_view",
        "vw_industry_funding": "d4_industry_view",
        "vw_loan_status_summary": "d5_status_view",
        "vw_jobs_per_dollar": "d6_jobs_per_dollar",
    }
    for view, question in over.items():
        found[f"a17_{view}"] = (_over_views(view), over_loans(VIEW_QUESTIONS[question].sql()))
    return found


def _loaded_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _clean_path(spark.sparkContext.applicationId, spark, sf_dir)
    result = jobs.load_files_job(spark, path, scratch_path(spark, "loaded"))
    return plain(measures.state_view(result.loans))


def _loaded_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = sinks.save_clean(cleaned(spark, sf_dir), scratch_path(spark, "clean-csv"), "csv")
    result = jobs.load_files_job(spark, path, scratch_path(spark, "loaded"), "csv")
    return plain(measures.state_view(result.loans))


def _viewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned(spark, sf_dir).createOrReplaceTempView("clean_loans")
    jobs.view_job(spark, "clean_loans")
    return plain(spark.table("vw_state_funding"))


def _existence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = cleaned(spark, sf_dir)
    rows.createOrReplaceTempView("clean_loans")
    return rows.agg(
        F.lit(sinks.table_exists(spark, "clean_loans")).alias("there"),
        F.lit(sinks.table_exists(spark, "no_such_loans")).alias("not_there"),
        (F.count(F.lit(1)) > 0).alias("has_rows"),
        F.lit(sinks.has_rows(rows.where("loan_id IS NULL"))).alias("none_has_rows"),
    )
