"""A loans table derived from the test tables, in Spark and as SQL.

Only the tables behind the wanted columns are joined: each join is a left join
on the key of its table, so leaving one out changes no other column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.sources.discover import list_files

# Column: (table it needs besides lineitem, expression valid in both dialects).
_AMOUNT = "CAST(l_extendedprice AS DECIMAL(18,2))"
MAPPING: dict[str, tuple[str | None, str]] = {
    "loan_id": (None, "l_orderkey*10 + l_linenumber"),
    "program": (
        "orders",
        "CASE WHEN o_orderpriority IN ('1-URGENT','2-HIGH') THEN '504' ELSE '7A' END",
    ),
    "borrower_state": ("nation", "CASE WHEN mod(l_orderkey,97)=0 THEN NULL ELSE n_name END"),
    "lender_name": ("supplier", "CASE WHEN l_linenumber=7 THEN NULL ELSE s_name END"),
    "third_party_lender_name": (
        "supplier",
        "CASE WHEN l_linenumber=7 AND mod(l_orderkey,2)=0 THEN concat('TPL ',s_name) END",
    ),
    "cdc_name": (
        "supplier",
        "CASE WHEN l_linenumber=7 AND mod(l_orderkey,3)=0 THEN concat('CDC ',s_name) END",
    ),
    "naics_code": (
        None,
        "CASE WHEN mod(l_partkey,53)=0 THEN NULL ELSE "
        "concat(CAST(11+mod(l_partkey*7,85) AS VARCHAR(2)), "
        "lpad(CAST(mod(l_partkey,20) AS VARCHAR(4)),4,'0')) END",
    ),
    "naics_description": ("part", "CASE WHEN mod(l_partkey,59)=0 THEN NULL ELSE p_name END"),
    "loan_amount": (None, f"CASE WHEN mod(l_orderkey,101)=0 THEN NULL ELSE {_AMOUNT} END"),
    "sba_guaranteed_approval": (
        None,
        f"CAST({_AMOUNT} * CAST(1-l_discount AS DECIMAL(4,2)) AS DECIMAL(18,2))",
    ),
    "charge_off_amount": (
        None,
        f"CASE WHEN l_returnflag='R' THEN "
        f"CAST({_AMOUNT} * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,2)) END",
    ),
    "jobs_supported": (
        None,
        "CASE WHEN mod(l_orderkey,89)=0 THEN NULL ELSE CAST(l_quantity AS INT) END",
    ),
    "approval_date": (None, "CAST(l_shipdate AS DATE)"),
    "approval_fiscal_year": (
        None,
        "CAST(year(l_shipdate) + CASE WHEN month(l_shipdate) >= 10 THEN 1 ELSE 0 END AS INT)",
    ),
    "loan_status": (
        None,
        "CASE WHEN mod(l_orderkey,83)=0 THEN NULL WHEN l_returnflag='R' THEN 'CHGOFF' "
        "WHEN l_linestatus='F' THEN 'P I F' ELSE 'EXEMPT' END",
    ),
    "as_of_date": (None, "DATE '2025-12-31'"),
}
COLUMNS = list(MAPPING)

# Table: (key in it, table that refers to it, referring column).
_KEYS = {
    "orders": ("o_orderkey", None, "l_orderkey"),
    "customer": ("c_custkey", "orders", "o_custkey"),
    "nation": ("n_nationkey", "customer", "c_nationkey"),
    "supplier": ("s_suppkey", None, "l_suppkey"),
    "part": ("p_partkey", None, "l_partkey"),
}

SQL = (
    "SELECT "
    + ", ".join(f"{text} AS {name}" for name, (_, text) in MAPPING.items())
    + " FROM lineitem"
    + "".join(f" LEFT JOIN {t} ON {ref} = {key}" for t, (key, _, ref) in _KEYS.items())
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Tables that are looked up from orders; whoever needs customers needs all of them.
_OF_ORDERS = ("orders", "customer", "nation")


def _broadcasts(df: DataFrame) -> bool:
    """Whether Spark, by its estimate of the size, broadcasts a table when it is joined."""
    size = df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()
    limit = df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return int(str(size)) <= limit


def joined_bytes(spark: SparkSession, sf_dir: str) -> int:
    """About how many bytes the shuffles of the joins hold; Parquet opens to several times its size."""
    files = [f for t in ("lineitem", "orders") for f in list_files(spark, f"{sf_dir}/{t}.parquet", "*")]
    return 4 * sum(f.length for f in files)


def _expression(name: str) -> Column:
    return F.expr(MAPPING[name][1]).alias(name)


def derive(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The loans table with the named columns, or all.

    Join strategies are left to Spark, which broadcasts a table only when its
    size is known to be small and splits skewed keys at run time.  Customers too many for
    that meet their orders first: else a second shuffle of all rows would look them up.
    """
    wanted: Sequence[str] = columns or COLUMNS
    needed: set[str] = set()
    for name in wanted:
        step = MAPPING[name][0]
        while step:
            needed.add(step)
            step = _KEYS[step][1]
    rows, orders = table(spark, sf_dir, "lineitem"), None
    for name, (key, _, reference) in _KEYS.items():
        if name not in needed:
            continue
        other = table(spark, sf_dir, name)
        if name == "orders" and "customer" in needed:
            customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
            orders = None if _broadcasts(customers) else other
        if orders is not None and name in _OF_ORDERS:
            if name != "orders":
                orders = orders.join(other, F.col(reference) == F.col(key), "left")
            if name == _OF_ORDERS[-1]:
                rows = rows.join(orders, F.col("l_orderkey") == F.col("o_orderkey"), "left")
            continue
        rows = rows.join(other, F.col(reference) == F.col(key), "left")
    return rows.select(*[_expression(c) for c in wanted])
