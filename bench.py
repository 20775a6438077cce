"""Time the headline queries and print one JSON line.

Reads ``BENCH_SF_DIR`` (default ``/root/testdata/sf0.1``) on ``BENCH_CPUS`` local
threads.  A query is timed warm, as the median of ``BENCH_RUNS`` runs.  The loans
table is loaded first, in the layout the library gives it (``load``); ``cold``
queries read its files, ``persisted`` ones read it from memory.  ``derived``
queries start from the given tables, joins included.
"""

from __future__ import annotations

import json
import os
import statistics
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from checks import file_queries, loans, raw_files
from checks.measure_queries import QUESTIONS, VIEW_QUESTIONS
from lendscope.operators import cleaning, profiling, sinks
from lendscope.plans import jobs
from lendscope.plans.dashboard import dashboard, kept_dashboard
from lendscope.plans.store import LoanStore
from lendscope.session import configure, scratch_path
from lendscope.sources.discover import discover

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "5"))


def session() -> SparkSession:
    """A local session of the wanted size."""
    made = configure(
        SparkSession.builder.master(f"local[{CPUS}]")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
    ).getOrCreate()
    made.sparkContext.setLogLevel("OFF")
    return made


def run(frame: DataFrame) -> None:
    """Compute all rows and columns and keep none."""
    frame.write.format("noop").mode("overwrite").save()


def seconds(action: Callable[[], object], runs: int = RUNS) -> float:
    """Median time of the action, after one run to warm up."""
    times = []
    for _ in range(runs + 1):
        start = time.perf_counter()
        action()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times[1:]), 4)


def main() -> None:
    """Run everything and print the line."""
    spark = session()
    queries: dict[str, float] = {}

    def load() -> str:
        path = scratch_path(spark, "bench-loans")
        sinks.write_table_files(loans.derive(spark, SF_DIR), path)
        return path

    queries["load"] = seconds(load, 1)
    table = sinks.read_table_files(spark, load())
    kept = table.drop("source_file").persist()

    questions = {**QUESTIONS, **VIEW_QUESTIONS}
    for name, question in questions.items():
        queries[f"{name}_cold"] = seconds(lambda: run(question.ask(table)))
    run(kept)
    for name, question in questions.items():
        queries[f"{name}_persisted"] = seconds(lambda: run(question.ask(kept)))
    kept.unpersist()

    def page() -> None:
        shown = dashboard(table)
        for panel in shown.panels.values():
            run(panel)
        shown.release()

    queries["h5_dashboard_cold"] = seconds(page, 3)
    store = LoanStore(spark, scratch_path(spark, "bench-store"))
    queries["load_with_kept_totals"] = seconds(lambda: store.refresh(loans.derive(spark, SF_DIR)), 1)

    def kept_page() -> None:
        for panel in kept_dashboard(store.totals()).panels.values():
            run(panel)

    queries["h5_kept_dashboard_cold"] = seconds(kept_page, 3)
    queries["d18_numeric_stats_cold"] = seconds(lambda: run(profiling.numeric_stats(table)), 3)
    queries["d17_null_percentages_cold"] = seconds(lambda: run(profiling.null_percentages(table)), 3)

    folder = raw_files.write(spark, SF_DIR)
    raw = [f"{folder}/program_*"]
    queries["h2_clean_files"] = seconds(
        lambda: jobs.clean_job(spark, raw, scratch_path(spark, "bench-clean")), 1
    )
    texts = file_queries.csv_files.read_raw(spark, discover(spark, raw))
    stored = scratch_path(spark, "bench-raw")
    texts.write.parquet(stored)
    texts = spark.read.parquet(stored).repartition(int(CPUS)).persist()
    run(texts)
    queries["h2_clean_rows_persisted"] = seconds(lambda: run(cleaning.clean(texts)), 3)
    texts.unpersist()

    for name in ("d1_overview", "d7_state_funding", "d10_charge_off_by_sector"):
        question = questions[name]
        queries[f"{name}_derived"] = seconds(
            lambda: run(question.ask(loans.derive(spark, SF_DIR, *question.columns)))
        )

    print(
        json.dumps(
            {
                "metric": "sum of median query seconds",
                "value": round(sum(queries.values()), 4),
                "unit": "sec",
                "queries": queries,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "rows": table.count(),
                "spark": spark.version,
                "cpus": int(CPUS),
                "runs": RUNS,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
