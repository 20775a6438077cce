"""Which raw files to read (A1, A2)."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession


@dataclass(frozen=True)
class SourceFile:
    """A raw file and its size in bytes."""

    path: str
    length: int


def list_files(spark: SparkSession, pattern: str, names: str = "*.csv") -> list[SourceFile]:
    """The files a path, folder or glob stands for, sorted; none if nothing matches.

    Listing through a DataFrame reads no file content and works on every file
    system Spark knows.
    """
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", names)
        .option("recursiveFileLookup", "true")
    )
    try:
        found = files.load(pattern).select("path", "length").collect()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return []
        raise
    return sorted((SourceFile(r.path, r.length) for r in found), key=lambda f: f.path)


def discover(spark: SparkSession, candidates: Sequence[str | Sequence[str]]) -> list[SourceFile]:
    """A1: the files of the first candidate that has any.

    A candidate is a path or glob, or a list of exact paths, of which those that
    exist count.  Nothing anywhere gives an empty list.
    """
    for candidate in candidates:
        patterns = [candidate] if isinstance(candidate, str) else candidate
        found = [file for pattern in patterns for file in list_files(spark, pattern)]
        if found:
            return found
    return []


def require(files: Sequence[SourceFile], candidates: object) -> Sequence[SourceFile]:
    """A2: the files, or an error that names where they were looked for."""
    if not files:
        raise FileNotFoundError(f"no raw CSV files were found in {candidates}")
    return files
