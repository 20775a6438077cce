"""Edge cases of single cells."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.functions import cells, labels, ratios, sectors
from lendscope.model import CLEANING_NA_TOKENS, NA_TOKENS, SECTORS

NUMBERS = {
    "1000": ("1000.00", 1000),
    "$1,234.50": ("1234.50", None),
    "1,000": ("1000.00", 1000),
    "12%": ("12.00", 12),
    "(500)": (None, None),
    "-3.25": ("-3.25", None),
    "1e5": ("100000.00", 100000),
    "12.0": ("12.00", 12),
    "3.5": ("3.50", None),
    "abc": (None, None),
    "N.A.": (None, None),
    "$": (None, None),
    "--5": (None, None),
    "1 000": (None, None),
    "1_000": (None, None),
    "0x1F": (None, None),
    "inf": (None, None),
    "5.": ("5.00", 5),
    "+7": ("7.00", 7),
    "007": ("7.00", 7),
    ".5": ("0.50", None),
    "1.005": ("1.01", None),
    "12,34": ("1234.00", 1234),
    "99999999999": ("99999999999.00", None),
    "1" + "0" * 17: (None, None),
}
DATES = {
    "12/31/2025": dt.date(2025, 12, 31),
    "1/5/2025": dt.date(2025, 1, 5),
    "2025-12-31": dt.date(2025, 12, 31),
    "13/01/2025": None,
    "2/30/2024": None,
    "01/05/25": None,
    "20251231": None,
    "12/31/2025 00:00:00": None,
    "": None,
}


def one_column(spark, texts, name="cell"):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"id int, {name} string")


def apply(spark, texts, function):
    rows = one_column(spark, texts).select("id", function(F.col("cell")).alias("r")).collect()
    return [r.r for r in sorted(rows, key=lambda r: r.id)]


def test_numbers(spark):
    decimals = apply(spark, NUMBERS, cells.to_decimal)
    integers = apply(spark, NUMBERS, cells.to_integer)
    assert decimals == [None if d is None else Decimal(d) for d, _ in NUMBERS.values()]
    assert integers == [i for _, i in NUMBERS.values()]


def test_dates(spark):
    assert apply(spark, DATES, cells.to_date) == list(DATES.values())


@settings(
    max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(
    st.lists(
        st.text(st.sampled_from("ab \t\n\x0b\x1c\x85\xa0 　﻿")),
        min_size=60,
        max_size=60,
    )
)
def test_strip_takes_all_white_space(spark, texts):
    assert apply(spark, texts, cells.strip) == [t.strip() for t in texts]
    assert apply(spark, texts, cells.blank_to_null) == [t if t.strip() else None for t in texts]


def test_tokens_are_compared_untrimmed(spark):
    texts = ["NULL", " NULL ", "", " ", "  ", "n/a", "None", "null?", None]
    assert apply(spark, texts, lambda c: cells.null_tokens(c, NA_TOKENS)) == [
        None, " NULL ", None, " ", "  ", None, None, "null?", None,
    ]
    assert apply(spark, [" ", "  "], lambda c: cells.null_tokens(c, CLEANING_NA_TOKENS)) == [
        None, "  ",
    ]


def test_symbols(spark):
    assert apply(spark, ["$1", "1,2", "3%", "4"], cells.has_symbols) == [True, True, True, False]


def test_sector(spark):
    texts = [*SECTORS, "722511", "99", "", "7", None]
    assert apply(spark, texts, sectors.sector_of) == [
        *SECTORS.values(), "Accommodation and Food Services", "Other / Unclassified",
        "Other / Unclassified", "Other / Unclassified", "Unknown",
    ]


@pytest.mark.parametrize(
    ("top", "bottom", "on_zero", "expected"),
    [(1, 4, None, 0.25), (1, 0, None, None), (1, 0, 0, 0.0), (1, None, 0, None), (None, 2, 0, None)],
)
def test_safe_ratio(spark, top, bottom, on_zero, expected):
    frame = spark.createDataFrame([(top, bottom)], "a int, b int")
    ratio = ratios.safe_ratio(F.col("a"), F.col("b"), on_zero)
    assert frame.select(ratio.alias("r")).first().r == expected


def test_labels(spark):
    values = [1234.5, 2.5, 3.5, 0.0, None, -5.4]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    rows = frame.select(
        labels.currency(F.col("v")).alias("money"), labels.count(F.col("v")).alias("count")
    ).collect()
    assert [r.money for r in rows] == ["$1,234", "$2", "$4", "$0", "$0", "$-5"]
    assert [r["count"] for r in rows] == ["1,234", "2", "3", "0", "0", "-5"]
    shares = [0.0412, 0.0225, 1.0, None, 0.0]
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(shares)], "i int, v double")
    rows = frame.select(labels.percent(F.col("v")).alias("p")).collect()
    assert [r.p for r in rows] == ["4.1%", "2.2%", "100.0%", "0.0%", "0.0%"]


def test_whole_numbers_of_plain_digits_go_without_a_remainder(spark):
    texts = [
        "0", "7", "007", "2001.0", "2001.000000000", "2001.0000000000", "12.", ".0", "1.5", "1e5",
        "-3", "+3", "-0", "1,000", "$12", "12%", "12\n", " 12 ", "12.0\n", "\x7f12", "１２", "",
        "2147483647", "2147483648", "999999999999999999", "9223372036854775807",
        "9223372036854775808", "99999999999999999999", "123456789012345678.0", "x", None,
    ]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for kind in (T.IntegerType(), T.LongType(), T.ShortType()):
        number = cells.without_symbols(F.col("t")).try_cast(T.DecimalType(38, 18))
        slow = F.when(number % 1 == 0, number.try_cast(kind))
        found = rows.select("t", cells.to_integer(F.col("t"), kind).alias("a"), slow.alias("b"))
        assert all(r.a == r.b for r in found.collect())
    plan = rows.select(cells.to_integer(F.col("t")))._jdf.queryExecution().analyzed().toString()
    assert plan.index("RLIKE") < plan.index("% ")
