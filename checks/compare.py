"""Run queries and their SQL side by side and report the differences.

    python -m checks.compare [folder of tables] [name ...]
"""

from __future__ import annotations

import math
import sys
import time
from collections import Counter
from typing import Any

import duckdb
from pyspark.sql import SparkSession

from checks.registry import all_queries
from lendscope.session import configure

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    """The given tables as views."""
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')"
        )
    return connection


def _same_form(value: Any) -> Any:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    return value


def _rows(columns: list[str], rows: list[tuple]) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_same_form(row[i]) for i in order) for row in rows)


def difference(spark: SparkSession, connection, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its SQL; none when nothing does."""
    run, sql = all_queries()[name]
    found = run(spark, sf_dir)
    expected = connection.execute(sql)
    columns = [c[0] for c in expected.description]
    if sorted(columns) != sorted(found.columns):
        return f"columns {sorted(found.columns)} instead of {sorted(columns)}"
    mine = _rows(found.columns, [tuple(r) for r in found.collect()])
    theirs = _rows(columns, expected.fetchall())
    if mine != theirs:
        extra, missing = list((mine - theirs).items()), list((theirs - mine).items())
        return (
            f"{mine.total()} rows instead of {theirs.total()}; "
            f"extra {extra[:3]}; missing {missing[:3]}"
        )
    return None if mine.total() else "no rows"


def main(arguments: list[str]) -> int:
    """Compare all queries, or those whose names are given."""
    sf_dir, *names = arguments or ["/root/testdata/sf0.01"]
    spark = configure(
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    ).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    connection = database(sf_dir)
    wrong = 0
    for name in names or all_queries():
        start = time.perf_counter()
        try:
            problem = difference(spark, connection, sf_dir, name)
        except Exception as error:  # noqa: BLE001 - one failure must not hide the others
            problem = f"{type(error).__name__}: {str(error)[:1500]}"
        took = time.perf_counter() - start
        print(f"{'FAIL' if problem else 'ok':4} {took:6.2f}s {name} {problem or ''}", flush=True)
        wrong += bool(problem) and problem != "no rows"
    print(f"{wrong} differ")
    return wrong


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
