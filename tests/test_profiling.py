"""Profiles against pandas and brute force."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from lendscope.operators import cleaning, profiling, selection


@pytest.fixture(scope="module")
def numbers(spark):
    draw = np.random.default_rng(7)
    n = 5000
    frame = pd.DataFrame(
        {
            "skewed": np.where(draw.random(n) < 0.4, 7.0, draw.lognormal(3, 2, n).round(2)),
            "whole": draw.integers(-50, 50, n).astype(float),
            "gaps": np.where(draw.random(n) < 0.3, np.nan, draw.normal(0, 1e6, n).round(2)),
            "one": np.where(np.arange(n) == 17, 3.25, np.nan),
        }
    )
    return frame, spark.createDataFrame(frame.replace({np.nan: None})).repartition(8)


@pytest.mark.parametrize("partitions", ["1", "8"])
def test_stats_equal_pandas(spark, numbers, partitions):
    frame, df = numbers
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        rows = {r.column_name: r for r in profiling.numeric_stats(df).collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    expected = frame.describe()
    names = {"25%": "p25", "50%": "p50", "75%": "p75"}
    for column in frame:
        for statistic, value in expected[column].items():
            found = rows[column][names.get(statistic, statistic)]
            if np.isnan(value):
                assert found is None
            else:
                assert found == pytest.approx(value, abs=0.0051)


def test_exact_quantiles(numbers):
    frame, df = numbers
    found = {r.column_name: r for r in profiling.quantiles(df, ["skewed", "gaps"], [0, 0.1, 0.99, 1]).collect()}
    for column in ("skewed", "gaps"):
        for q in (0, 0.1, 0.99, 1):
            expected = frame[column].quantile(q)
            assert found[column][f"p{round(q * 100)}"] == pytest.approx(expected, rel=1e-12)


FRACTIONS = (0, 0.1, 0.25, 0.5, 0.9, 1)


def assert_quantiles(frame, found):
    for row in found.collect():
        values = frame[row.column_name].dropna().to_numpy()
        for q in FRACTIONS:
            assert row[f"p{round(q * 100)}"] == pytest.approx(np.quantile(values, q), rel=1e-12)


@pytest.mark.parametrize("most", [1, 10**6])
def test_quantiles_by_rounds(numbers, most):
    frame, df = numbers
    found = profiling.quantiles(df, list(frame), FRACTIONS, most=most)
    assert found.count() == 4
    assert_quantiles(frame, found)


def test_splitters_that_miss_cost_a_round(numbers, monkeypatch):
    """Most wanted ranks are outside of the first splitters, which are values of no row."""
    frame, df = numbers
    rounds = []
    splitters = selection._splitters
    monkeypatch.setattr(
        selection,
        "_splitters",
        lambda v, s: rounds.append(s) or ([(0.1, 1.1)] * len(s) if len(rounds) == 1 else splitters(v, s)),
    )
    assert_quantiles(frame, profiling.quantiles(df, list(frame), FRACTIONS, most=40))
    assert len(rounds) > 1


def assert_quantiles_of(df, column, most, expected):
    row = profiling.quantiles(df, [column], [0.25, 0.5], most=most).head()
    assert (row.p25, row.p50) == pytest.approx(expected, rel=1e-12)


def test_quantiles_of_many_distinct_sorted_values(spark):
    """Sorted partitions differ from each other as much as they can."""
    n = 10_000_000
    df = spark.range(0, n, 1, 16).select(F.col("id").cast("double").alias("x"))
    assert_quantiles_of(df, "x", 20_000, [(n - 1) * 0.25, (n - 1) * 0.5])


def test_quantiles_of_two_values_and_of_endless_ones(spark):
    rows = spark.range(0, 9000, 1, 4)
    two = F.when(F.col("id") % 3 == 0, 1.0).otherwise(2.0)
    assert_quantiles_of(rows.select(two.alias("x")), "x", 10, [1.0, 2.0])
    far = F.when(F.col("id") < 4000, F.lit(float("-inf"))).otherwise(F.exp(F.col("id") / 15))
    assert_quantiles_of(
        rows.select(far.alias("x")), "x", 10,
        [float("-inf"), (np.exp(4499 / 15) + np.exp(4500 / 15)) / 2],
    )


def test_no_task_orders_more_than_stated(spark, monkeypatch):
    seen = []
    ordered = selection._ordered
    monkeypatch.setattr(
        selection, "_ordered", lambda v, s: seen.extend(x.within for x in s) or ordered(v, s)
    )
    df = spark.range(0, 50_000, 1, 8).select(F.rand(3).alias("x"))
    profiling.quantiles(df, ["x"], [0.1, 0.5], most=500)
    assert seen and max(seen) <= 500


def test_approximate_stats_take_one_pass(numbers):
    frame, df = numbers
    stats = profiling.numeric_stats(df, ["whole"], exact=False)
    row = stats.first()
    assert abs(row.p50 - frame["whole"].median()) <= 1
    assert stats.columns == profiling.numeric_stats(df, ["whole"]).columns


def test_empty_input(spark):
    empty = spark.createDataFrame([], "a double, b string")
    assert profiling.null_percentages(empty).where("null_percentage is not null").isEmpty()
    row = profiling.numeric_stats(empty).first()
    assert row["count"] == 0 and row["mean"] is None and row.p50 is None
    assert cleaning.duplicate_count(empty).first().duplicate_rows == 0


def test_nulls_and_duplicates(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1), (None, None)], "t string, n int")
    shares = [tuple(r) for r in profiling.null_percentages(df).collect()]
    assert shares == [("n", 75.0), ("t", 25.0)]
    assert cleaning.duplicate_count(df).first().duplicate_rows == 1
    assert cleaning.drop_duplicates(df).count() == 3
    summary = profiling.run_summary(cleaning.copy_counts(df), len(df.columns)).first()
    assert tuple(summary) == (3, 2, 1)


def test_a_row_copied_very_often(spark):
    rows = spark.range(0, 100_000, 1, 8)
    text = F.when(F.col("id") % 3 == 0, F.lit("copy")).otherwise(F.col("id").cast("string"))
    df = rows.select(text.alias("t"))
    distinct = cleaning.drop_duplicates(df)
    assert distinct.count() == 66_667
    assert cleaning.duplicate_count(df).first().duplicate_rows == 33_333
    plan = distinct._jdf.queryExecution().executedPlan().toString()
    assert plan.count("HashAggregate") == 2
