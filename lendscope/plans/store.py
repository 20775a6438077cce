"""A loans table whose readers only ever see whole loads.

Each load writes its rows and their totals into folders of its own.  A small manifest
names the folders that count; it is put in place by one rename after a load has
succeeded.  A refresh names only its own folder, an added load all earlier ones too.  So a
reader sees the table before or after a load, the totals belong to the rows, and a load
that fails or is repeated changes nothing.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lendscope.operators import kept_totals
from lendscope.operators.sinks import TABLE_SCHEMA, YEAR, Arrangement, arrange, table_rows
from lendscope.session import free_shuffles

_MANIFEST, _LOAD = "MANIFEST", "load"


class LoanStore:
    """The loans under a path that all executors reach.

    Each load's rows are laid out by ``arranged`` and written with ``options``.
    """

    def __init__(
        self, spark: SparkSession, path: str, arranged: Arrangement = arrange, **options: str
    ):
        self.spark, self.path = spark, path.rstrip("/")
        self._arranged, self._options = arranged, options
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        self._root = jvm.org.apache.hadoop.fs.Path(self.path)
        self._files = self._root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def loads(self) -> list[str]:
        """Names of the loads that count, oldest first."""
        manifest = self._jvm.org.apache.hadoop.fs.Path(self._root, _MANIFEST)
        if not self._files.exists(manifest):
            return []
        stream = self._files.open(manifest)
        try:
            text = self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        return text.split()

    def _switch(self, loads: list[str]) -> None:
        fs = self._jvm.org.apache.hadoop.fs
        beside = fs.Path(self._root, f"{_MANIFEST}-{uuid.uuid4().hex}")
        stream = self._files.create(beside, False)
        try:
            stream.write(bytearray("\n".join(loads).encode()))
        finally:
            stream.close()
        # A rename that replaces its target is one step on file systems that have renames.
        rename = self._jvm.org.apache.hadoop.fs.Options.Rename
        how = self.spark.sparkContext._gateway.new_array(rename, 1)
        how[0] = rename.OVERWRITE
        configuration = self.spark.sparkContext._jsc.hadoopConfiguration()
        context = fs.FileContext.getFileContext(self._root.toUri(), configuration)
        context.rename(
            self._files.makeQualified(beside),
            self._files.makeQualified(fs.Path(self._root, _MANIFEST)),
            how,
        )

    def _write(self, cleaned: DataFrame) -> str:
        name = uuid.uuid4().hex
        loans = f"{self.path}/loans/{_LOAD}={name}"
        rows = table_rows(cleaned, self._arranged)
        rows.write.options(**self._options).partitionBy(YEAR).parquet(loans)
        free_shuffles(self.spark)
        written = self.spark.read.schema(TABLE_SCHEMA).parquet(loans)
        kept_totals.write_totals(written, f"{self.path}/totals/{_LOAD}={name}")
        return name

    def refresh(self, cleaned: DataFrame) -> str:
        """Replace all rows; readers see the old ones until all new ones are there."""
        name = self._write(cleaned)
        self._switch([name])
        return name

    def add(self, cleaned: DataFrame) -> str:
        """Add the rows of a load.  One writer at a time."""
        name = self._write(cleaned)
        self._switch([*self.loads(), name])
        return name

    def _read(self, part: str, schema: T.StructType) -> DataFrame:
        base = f"{self.path}/{part}"
        folders = [f"{base}/{_LOAD}={name}" for name in self.loads()]
        if not folders:
            raise ValueError(f"no load has succeeded under {self.path}")
        reader = self.spark.read.schema(schema).option("basePath", base)
        return reader.parquet(*folders).select(*schema.names)

    def loans(self) -> DataFrame:
        """The rows of all loads that count.  Row keys are unique within a load."""
        return self._read("loans", TABLE_SCHEMA)

    def totals(self) -> DataFrame:
        """Their stored totals, for ``kept_dashboard``."""
        empty = self.spark.createDataFrame([], TABLE_SCHEMA)
        return self._read("totals", kept_totals.totals_schema(empty))
