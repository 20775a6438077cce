"""Values at given ranks of many columns, found by rounds.

A round narrows the bracket of open values around each wanted rank.  Splitters come from
quantiles of groups of partitions, put together by weight, and what lies below, at and
between them is counted exactly, so a poor splitter costs a round and never the result.
Once few enough rows are left in a bracket they are ordered.  No task meets the sketches
of all tasks, nor more rows of a bracket than the stated number.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a bracket that one task may order.
MOST_LEFT = 250_000
#: Groups of partitions whose quantiles are taken apart, and steps between 0 and 1 of each.
_GROUPS, _STEPS = 256, 400
_ACCURACY = 1000
#: Splitters stand this share of the bracket on either side of the rank.
_MARGIN = 0.005


@dataclass(frozen=True)
class _Search:
    """The values of a column strictly between two, and a rank among all its values."""

    column: int
    rank: int
    low: float | None
    high: float | None
    before: int
    within: int

    @property
    def bracket(self) -> tuple[int, float | None, float | None]:
        return self.column, self.low, self.high


def _inside(value: Column, low: float | None, high: float | None) -> Column:
    inside = value.isNotNull()
    if low is not None:
        inside &= value > F.lit(low)
    if high is not None:
        inside &= value < F.lit(high)
    return inside


def _splitters(values: DataFrame, searches: list[_Search]) -> list[tuple[float, float]]:
    """Two values of the bracket for each search, below and above its rank or near it."""
    spark = values.sparkSession
    brackets = list(dict.fromkeys(s.bracket for s in searches))
    steps = [i / _STEPS for i in range(_STEPS + 1)]
    picked = [
        F.when(_inside(F.col(f"v{column}"), low, high), F.col(f"v{column}"))
        for column, low, high in brackets
    ]
    sketch = [
        F.struct(
            F.lit(i).alias("bracket"),
            F.count(value).alias("n"),
            F.percentile_approx(value, steps, _ACCURACY).alias("points"),
        )
        for i, value in enumerate(picked)
    ]
    points = (
        values.groupBy(F.pmod(F.spark_partition_id(), F.lit(_GROUPS)).alias("group"))
        .agg(F.array(*sketch).alias("sketches"))
        .select(F.inline("sketches"))
        .where("n > 0")
        .select(
            "bracket", (F.col("n") / len(steps)).alias("weight"), F.explode("points").alias("value")
        )
        .groupBy("bracket", "value")
        .agg(F.sum("weight").alias("weight"))
    )
    below = Window.partitionBy("bracket").orderBy("value")
    placed = points.withColumn(
        "below", F.sum("weight").over(below.rowsBetween(Window.unboundedPreceding, 0))
    )
    # A row per search: bounded by the columns and fractions asked for.
    wanted = spark.createDataFrame(
        [
            (i, brackets.index(s.bracket), float(s.rank - s.before), s.within * _MARGIN)
            for i, s in enumerate(searches)
        ],
        "search int, bracket int, place double, margin double",
    )
    low, high = F.col("place") - F.col("margin"), F.col("place") + F.col("margin")
    found = (
        placed.join(F.broadcast(wanted), "bracket")
        .groupBy("search")
        .agg(
            F.coalesce(F.max(F.when(F.col("below") <= low, F.col("value"))), F.min("value")).alias("a"),
            F.coalesce(F.min(F.when(F.col("below") >= high, F.col("value"))), F.max("value")).alias("b"),
        )
    )
    by_search = {r["search"]: (min(r["a"], r["b"]), max(r["a"], r["b"])) for r in found.collect()}
    return [by_search[i] for i in range(len(searches))]


def _narrowed(
    values: DataFrame, searches: list[_Search], splitters: list[tuple[float, float]]
) -> list[_Search | float]:
    """Each search in the part of its bracket that holds the rank, or the value found."""
    counts = []
    for i, (s, (a, b)) in enumerate(zip(searches, splitters, strict=True)):
        value = F.col(f"v{s.column}")
        inside = _inside(value, s.low, s.high)
        counts += [
            F.count_if(inside & (value < a)).alias(f"under{i}"),
            F.count_if(inside & (value == a)).alias(f"first{i}"),
            F.count_if(inside & (value > a) & (value < b)).alias(f"between{i}"),
            F.count_if(inside & (value == b)).alias(f"last{i}"),
        ]
    counted = values.agg(*counts).head()
    results: list[_Search | float] = []
    for i, (s, (a, b)) in enumerate(zip(searches, splitters, strict=True)):
        under, first = counted[f"under{i}"], counted[f"first{i}"]
        between, last = counted[f"between{i}"], counted[f"last{i}"] if b != a else 0
        parts = [(under, s.low, a), (first, a, a), (between, a, b), (last, b, b)]
        parts.append((s.within - under - first - between - last, b, s.high))
        before = s.before
        for size, low, high in parts:
            if s.rank < before + size:
                done = low == high and low is not None
                results.append(low if done else replace(s, low=low, high=high, before=before, within=size))
                break
            before += size
    return results


def _ordered(values: DataFrame, searches: list[_Search]) -> list[float]:
    """The values at the ranks of searches whose brackets are small."""
    spark = values.sparkSession
    brackets = list(dict.fromkeys(s.bracket for s in searches))
    spots = [
        F.when(
            _inside(F.col(f"v{column}"), low, high),
            F.struct(F.lit(i).alias("bracket"), F.col(f"v{column}").alias("value")),
        )
        for i, (column, low, high) in enumerate(brackets)
    ]
    counted = (
        values.select(F.inline(F.filter(F.array(*spots), lambda s: s.isNotNull())))
        .groupBy("bracket", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    in_order = Window.partitionBy("bracket").orderBy("value")
    through = F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0))
    ranks = spark.createDataFrame(
        [(i, brackets.index(s.bracket), s.rank - s.before) for i, s in enumerate(searches)],
        "search int, bracket int, place long",
    )
    held = (F.col("place") < F.col("through")) & (F.col("place") >= F.col("through") - F.col("n"))
    found = counted.withColumn("through", through).join(F.broadcast(ranks), "bracket").where(held)
    by_search = {r["search"]: r["value"] for r in found.select("search", "value").collect()}
    return [by_search[i] for i in range(len(searches))]


def values_at(
    values: DataFrame,
    sizes: list[int],
    wanted: Iterable[tuple[int, int]],
    most: int = MOST_LEFT,
) -> dict[tuple[int, int], float]:
    """The value at each (column, rank), ranks from 0 among the values that are not null.

    ``values`` has double columns v0, v1, ... of which ``sizes`` says how many values they
    hold.  Every round reads the values twice, leaves about a hundredth of a bracket and at
    least one value less, whatever the values are.
    """
    done: dict[tuple[int, int], float] = {}
    open_ = [_Search(c, r, None, None, 0, sizes[c]) for c, r in sorted(set(wanted))]
    small: list[_Search] = []
    while open_:
        small += [s for s in open_ if s.within <= most]
        open_ = [s for s in open_ if s.within > most]
        if not open_:
            break
        narrowed = _narrowed(values, open_, _splitters(values, open_))
        for s, result in zip(open_, narrowed, strict=True):
            if not isinstance(result, _Search):
                done[s.column, s.rank] = result
        open_ = [r for r in narrowed if isinstance(r, _Search)]
    if small:
        for s, value in zip(small, _ordered(values, small), strict=True):
            done[s.column, s.rank] = value
    return done
