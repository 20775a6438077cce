"""Stored totals that pages read instead of the loans.

A cut is a set of columns to add up by: any of the three filters of a page, and at most
one further key.  Totals add up, so each load stores those of its own rows and a reader
adds up what the loads stored.  A page reads the cut of just its filters and key: a few
rows of a folder of its own, sorted by the filters.  Industries and lenders together
have nearly as many combinations as there are loans, so one cut by all filters and
lenders, sorted by industry first, serves every page that filters on an industry.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lendscope.operators.filters import ALL, LoanFilter
from lendscope.operators.measures import (
    FACT_COLUMNS,
    INDUSTRY,
    LENDER,
    PROGRAM,
    STATE,
    STATUS,
    Facets,
    added_up,
    loan_measures,
)
from lendscope.session import discard, free_shuffles, scratch_path

YEAR = "approval_fiscal_year"
_FILTERS = (YEAR, STATE, INDUSTRY)
_EXTRAS = (None, STATUS, LENDER, PROGRAM)
#: A code comes with its descriptions, which questions about industries show.
_DESCRIPTION = "naics_description"
_KEYS = (YEAR, STATE, INDUSTRY, _DESCRIPTION, STATUS, LENDER, PROGRAM)


def _columns(filters: frozenset[str], extra: str | None) -> tuple[str, ...]:
    """The columns of the cut that answers for these filters and this key."""
    wanted = {*filters, *([extra] if extra else [])}
    if INDUSTRY in wanted and extra is None:
        wanted.add(_DESCRIPTION)
    if INDUSTRY in wanted and extra == LENDER:
        wanted.update(_FILTERS)
    return tuple(k for k in _KEYS if k in wanted)


def _name(columns: tuple[str, ...]) -> str:
    return "-".join(columns) or "all"


def _cuts() -> set[tuple[str, ...]]:
    """The columns of every cut."""
    subsets = [frozenset(c) for n in range(4) for c in combinations(_FILTERS, n)]
    return {_columns(filters, extra) for filters in subsets for extra in _EXTRAS}


# Totals that are added up from the loans.  Each cut comes from one of them, none from all keys
# at once: the combinations of all keys are hardly fewer than the loans.
_BASES = (
    (YEAR, STATE, INDUSTRY, _DESCRIPTION),
    (YEAR, STATE, INDUSTRY, LENDER),
    (YEAR, STATE, INDUSTRY, STATUS, PROGRAM),
)


def _base_totals(fact: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """The totals per combination of some keys."""
    latest = F.max("as_of_date").alias("latest_as_of_date")
    found = fact.groupBy(*keys).agg(*loan_measures(fact), latest)
    # Sums of sums have the widest type; every cut is stored in it.
    wide = {
        f.name: F.col(f.name).cast(T.DecimalType(38, f.dataType.scale))
        for f in found.schema
        if isinstance(f.dataType, T.DecimalType)
    }
    return found.withColumns(wide)


def _added(base: DataFrame) -> list:
    return [*added_up(base), F.max("latest_as_of_date").alias("latest_as_of_date")]


def _rolled(base: DataFrame, cuts: list[tuple[str, ...]]) -> DataFrame:
    """The totals of some cuts, in column ``cut``, from those per combination of more keys."""
    keys = [k for k in _KEYS if any(k in columns for columns in cuts)]
    numbers = {
        int("".join("0" if k in columns else "1" for k in keys) or "0", 2): _name(columns)
        for columns in cuts
    }
    name = F.element_at(
        F.create_map(*[F.lit(x) for pair in numbers.items() for x in pair]), F.col("grouping")
    )
    rolled = base.groupingSets(cuts, *keys).agg(
        F.grouping_id().cast("int").alias("grouping"), *_added(base)
    )
    return rolled.select(name.alias("cut"), *[c for c in rolled.columns if c != "grouping"])


def totals_schema(loans: DataFrame) -> T.StructType:
    """The columns of stored totals, the folder's name last."""
    measured = _base_totals(loans.select(*FACT_COLUMNS), ()).schema.fields
    keys = [T.StructField(k, loans.schema[k].dataType) for k in _KEYS]
    return T.StructType([*keys, *measured, T.StructField("cut", T.StringType())])


def write_totals(loans: DataFrame, path: str) -> None:
    """Store the totals of a load's rows under a new path.

    Three sets of keys are added up from the loans, one shuffle each, and stored; the
    smaller cuts come from those rows.  What is no cut itself goes again.
    """
    spark, fact = loans.sparkSession, loans.select(*FACT_COLUMNS)
    left = _cuts()
    for keys in _BASES:
        # A base that is a cut itself is stored as one, sorted for filters on the industry.
        folder = f"{path}/cut={_name(keys)}" if keys in left else scratch_path(spark, "base-totals")
        base = _base_totals(fact, keys)
        base.sortWithinPartitions(INDUSTRY, STATE, YEAR).write.parquet(folder)
        stored = spark.read.schema(base.schema).parquet(folder)
        mine = sorted(c for c in left if c != keys and set(c) <= set(keys))
        left -= {keys, *mine}
        _rolled(stored, mine).hint("rebalance", "cut").sortWithinPartitions(
            "cut", *[k for k in _FILTERS if any(k in c for c in mine)]
        ).write.mode("append").partitionBy("cut").parquet(path)
        if not folder.startswith(path):
            discard(spark, folder)
        free_shuffles(spark)


class KeptFacets(Facets):
    """The totals of one slice, from stored totals; questions take it in place of loans.

    ``table`` has the stored totals of all loads.  Each answer prunes to the folder of
    its cut, and the filters reach the scan.
    """

    def __init__(self, table: DataFrame, chosen: LoanFilter):
        self.table, self.chosen = table, chosen
        picked = zip((chosen.fiscal_year, chosen.state, chosen.naics_code), _FILTERS, strict=True)
        self._filters = frozenset(column for value, column in picked if value != ALL)

    def rows(self, key: str) -> DataFrame:
        """The slice's totals per value of one key; with the description for industries."""
        kept = [key, _DESCRIPTION] if key == INDUSTRY else [key]
        extra = key if key in _EXTRAS else None
        filters = self._filters | ({key} if extra is None else frozenset())
        cut = _name(_columns(filters, extra))
        mine = self.chosen.apply(self.table.where(F.col("cut") == F.lit(cut)))
        return mine.groupBy(*kept).agg(
            *added_up(mine), F.max("latest_as_of_date").alias("latest_as_of_date")
        )

    def release(self) -> None:
        """Nothing is held in memory."""


def dataset_scope(facets: KeptFacets) -> DataFrame:
    """D2 from the totals per year."""
    return facets.rows(YEAR).agg(
        F.coalesce(F.sum("total_loans"), F.lit(0)).alias("total_loans"),
        F.min(YEAR).alias("min_year"),
        F.max(YEAR).alias("max_year"),
        F.max("latest_as_of_date").alias("latest_as_of_date"),
    )
