"""Raw CSV files made from the derived loans: the same facts, written untidily.

Two programs have two header rows.  Amounts carry signs and thousands commas,
dates come in two forms, texts have odd white space around them, unknown cells
are spelled in several ways, some names hold quotes, commas and line breaks, and
every row of line number 1 is there twice.  What cleaning must give is said by
``EXPECTED``, from the given tables alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import loans
from lendscope.session import (
    SCRATCH_OPTIONS,
    discard,
    free_shuffles,
    scratch_path,
    sized_shuffles,
)

_WANTED = [
    "loan_id", "program", "borrower_state", "lender_name", "third_party_lender_name", "cdc_name",
    "naics_code", "naics_description", "loan_amount", "charge_off_amount", "jobs_supported",
    "approval_date", "approval_fiscal_year", "loan_status", "as_of_date",
]

# What a cleaned row must hold, over the loans query.  One amount in 71 is
# no number in the files, and one date in 79 is none.
EXPECTED = f"""
SELECT DISTINCT loan_id, program, borrower_state,
  CASE WHEN program = '504' THEN coalesce(lender_name, third_party_lender_name, cdc_name)
       ELSE lender_name END AS lender_name,
  naics_code, naics_description,
  CASE WHEN mod(loan_id, 71) = 0 THEN NULL ELSE loan_amount END AS loan_amount,
  charge_off_amount, jobs_supported,
  CASE WHEN mod(loan_id, 79) = 0 THEN NULL ELSE approval_date END AS approval_date,
  approval_fiscal_year, loan_status, as_of_date,
  concat('Owner "', CAST(loan_id AS VARCHAR(20)), '", Esq.',
         CASE WHEN mod(loan_id, 3) = 0 THEN chr(10) ELSE ' ' END, 'Ltd') AS borrower_name
FROM ({loans.SQL}) AS loans
"""


def _untidy(text: Column, number: Column) -> Column:
    """White space of several kinds around a text, and several words for unknown."""
    spaced = (
        F.when(number % 5 == 0, F.concat(F.lit("  "), text, F.lit("\t")))
        .when(number % 5 == 1, F.concat(F.lit(" "), text, F.lit("  ")))
        .otherwise(text)
    )
    unknown = F.element_at(
        F.array(*[F.lit(t) for t in ("", " ", "NULL", "n/a", "#N/A", "   ")]),
        (number % 6 + 1).cast("int"),
    )
    return F.coalesce(spaced, unknown)


def _money(amount: Column, number: Column) -> Column:
    plain = amount.cast("string")
    grouped = F.regexp_replace(plain, r"(?<=\d)(?=(\d{3})+\.)", ",")
    return (
        F.when(number % 4 == 0, F.concat(F.lit("$"), grouped))
        .when(number % 4 == 1, grouped)
        .otherwise(plain)
    )


def _day(day: Column, number: Column) -> Column:
    """Both forms of a date, month first for most rows."""
    return F.when(number % 4 == 0, day.cast("string")).otherwise(F.date_format(day, "M/d/yyyy"))


# Columns without white space around their cells, so that their types show.
_TIDY = ("L2LocID", "ApprovalFiscalYear")


def raw_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All raw rows as text, under the headers of both programs."""
    return _untidied(loans.derive(spark, sf_dir, *_WANTED))


def _untidied(fact: DataFrame) -> DataFrame:
    number = F.col("loan_id")
    copies = F.sequence(F.lit(1), F.when(number % 10 == 1, 2).otherwise(1))
    owner = F.concat(
        F.lit('Owner "'),
        number,
        F.lit('", Esq.'),
        F.when(number % 3 == 0, "\n").otherwise(" "),
        F.lit("Ltd"),
    )
    amount = (
        F.when(number % 142 == 0, F.lit("$N.A."))
        .when(number % 71 == 0, F.lit("N.A."))
        .otherwise(_money(F.col("loan_amount"), number))
    )
    approved = F.when(number % 79 == 0, F.lit("13/45/2001")).otherwise(
        _day(F.col("approval_date"), number)
    )
    cells = {
        "AsOfDate": _day(F.col("as_of_date"), number),
        "Program": F.col("program"),
        "L2LocID": number.cast("string"),
        "BorrName": owner,
        "BorrState": F.col("borrower_state"),
        "BankName": F.col("lender_name"),
        "ThirdPartyLender_Name": F.col("third_party_lender_name"),
        "CDC_Name": F.col("cdc_name"),
        "GrossApproval": amount,
        "ApprovalDate": approved,
        "ApprovalFiscalYear": F.concat(F.col("approval_fiscal_year"), F.lit(".0")),
        "NAICSCode": F.col("naics_code"),
        "NAICSDescription": F.col("naics_description"),
        "LoanStatus": F.col("loan_status"),
        "GrossChargeOffAmount": _money(F.col("charge_off_amount"), number),
        "JobsSupported": F.col("jobs_supported").cast("string"),
    }
    made = fact.select(
        F.explode(copies).alias("copy"),
        *[
            (cell if name in _TIDY else _untidy(cell, number)).alias(name)
            for name, cell in cells.items()
        ],
        F.col("program").alias("folder"),
    )
    return made.drop("copy")


_BANK_ONLY = ["ThirdPartyLender_Name", "CDC_Name"]
_OTHER_SPELLING = {"BorrState": "BORRSTATE", "GrossApproval": "Gross Approval"}


def write(spark: SparkSession, sf_dir: str, line_breaks: bool = True) -> str:
    """Write the raw files of both programs under a new folder and return it.

    The loans are derived once and stored until both programs are written from those.
    """
    folder, stored = scratch_path(spark, "raw"), scratch_path(spark, "raw-loans")
    fact = loans.derive(spark, sf_dir, *_WANTED)
    with sized_shuffles(spark, loans.joined_bytes(spark, sf_dir)):
        fact.write.options(**SCRATCH_OPTIONS).parquet(stored)
    free_shuffles(spark)
    rows = _untidied(spark.read.schema(fact.schema).parquet(stored))
    if not line_breaks:
        rows = rows.withColumn("BorrName", F.translate("BorrName", "\n", " "))
    programs = {
        "7A": rows.drop(*_BANK_ONLY),
        "504": rows.withColumnsRenamed(_OTHER_SPELLING),
    }
    for program, part in programs.items():
        (
            part.where(F.col("folder") == program)
            .drop("folder")
            .write.options(
                header=True, quote='"', escape='"', emptyValue="",
                ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
            )
            .csv(f"{folder}/program_{program}")
        )
    discard(spark, stored)
    return folder
