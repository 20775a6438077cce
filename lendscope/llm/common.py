"""Helpers of the training-data operators: stored steps, hash folds, worker imports."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lendscope.session import scratch_path

PACKAGE_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
#: Rows of texts handed to Python at once; long texts are whole, so this bounds a batch.
TEXT_ROWS = 256
#: Entries of the table of word hashes that a Python worker keeps.
_HASHES_KEPT = 250_000


class _WordHashes(dict):
    """Word: 64-bit hash; forgets all when it has grown too large."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _HASHES_KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


word_hashes = _WordHashes()
_holder: list[tuple[str, Callable[[], object]]] = [("hashes", word_hashes.clear)]


def hold(name: str, forget: Callable[[], object]) -> None:
    """Say whose tables a Python worker keeps from now on; those of another are forgotten.

    Workers live on from stage to stage, and would else keep the tables of each.
    """
    if _holder[0][0] != name:
        _holder[0][1]()
        _holder[:] = [(name, forget)]


_written: list[list[str]] = []


@contextmanager
def recording(paths: list[str]) -> Iterator[None]:
    """Note in ``paths`` the tables that are stored meanwhile, for ``drop``."""
    _written.append(paths)
    try:
        yield
    finally:
        _written.pop()


def drop(spark: SparkSession, paths: list[str]) -> None:
    """Delete stored tables that nothing reads any more, and forget them."""
    jvm = spark.sparkContext._jvm
    while paths:
        path = jvm.org.apache.hadoop.fs.Path(paths.pop())
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """The same rows, read from a table in the folder that all executors share.

    The rows are computed once, a lost executor loses none of them, and what
    follows has a short plan.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    if _written:
        _written[-1].append(path)
    df.write.parquet(path)
    # Shuffle files go once the driver's garbage collector finds their plans unused, which
    # a driver with little to do would leave for long.
    spark.sparkContext._jvm.System.gc()
    return spark.read.schema(df.schema).parquet(path)


def ready(spark: SparkSession) -> SparkSession:
    """Let Python workers find this package and take texts in small batches."""
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if PACKAGE_ROOT not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, PACKAGE_ROOT]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS))
    return spark


def fold(column: str, folds: int) -> Column:
    """CRC-32 of the id's decimal text, modulo ``folds``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % folds


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def with_texts(
    documents: DataFrame, id_column: str, text_column: str, carry: bool = False
) -> DataFrame:
    """doc_id and text and, to be carried through Python, the whole row as ``row``."""
    ready(documents.sparkSession)
    whole = [F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")] * carry
    return documents.select(
        F.col(id_column).cast("long").alias("doc_id"),
        F.col(text_column).cast("string").alias("text"),
        *whole,
    )


def with_row(schema: str, documents: DataFrame, carry: bool) -> str:
    """The schema text, with the carried row behind it."""
    return f"{schema}, row {documents.schema.simpleString()}" if carry else schema
