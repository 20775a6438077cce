"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

PARTITION_BYTES = 128 << 20
#: Write options of scratch, which is read once or twice: smaller files, not faster ones.
SCRATCH_OPTIONS = {"compression": "zstd"}
CHECKPOINT_SETTING = "spark.checkpoint.dir"

# Settings this library likes; apply with ``configure`` before the session starts.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A column such as program=504 must stay text when it is a folder name.
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    """Add the library's settings to a session builder."""
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


@contextmanager
def sized_shuffles(
    spark: SparkSession, size: int, most: int | None = None
) -> Iterator[None]:
    """Let shuffles of ``size`` bytes start with enough partitions to fit in memory.

    Never fewer than the session asks for.  Adaptive execution joins partitions that
    turn out small, so too many cost little and too few would spill.  The driver
    keeps where each map output lies, so with very many map tasks ``most`` can trade
    its memory for larger partitions.
    """
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    wanted = -(-size // PARTITION_BYTES)
    wanted = wanted if most is None else min(wanted, most)
    spark.conf.set(setting, str(max(int(before), wanted)))
    try:
        yield
    finally:
        spark.conf.set(setting, before)


@contextmanager
def pieces_together(spark: SparkSession, size: int) -> Iterator[None]:
    """Let a task take many pieces of files where pieces are set small.

    Files of ``size`` bytes are cut into the same pieces as before, but no longer into as many
    tasks: a task has 128 MB, or less where that would leave cores without work.
    """
    setting = "spark.sql.files.maxPartitionNum"
    before = spark.conf.get(setting, None)
    cores = spark.sparkContext.defaultParallelism
    spark.conf.set(setting, str(max(4 * cores, -(-size // PARTITION_BYTES))))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(setting)
        else:
            spark.conf.set(setting, before)


def discard(spark: SparkSession, *paths: str) -> None:
    """Delete scratch that nothing reads any more."""
    for name in paths:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let the shuffle files of finished jobs go.

    Spark deletes them once the driver's garbage collector finds their plans unused, which a
    driver with little to do would leave for long; those of all steps would add up on disk.
    """
    spark.sparkContext._jvm.System.gc()


def share_package(spark: SparkSession) -> None:
    """Let Python workers on this machine import the package; a cluster gets it as py-files."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = spark.sparkContext.environment
    known = environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    Where the session names none, one is made for a local session, whose threads
    all see it, and removed when the program ends; a cluster's session must name
    one, since a folder of one machine would hide files from the others.
    """
    context = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_SETTING, None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local[") and context.master != "local":
            raise ValueError(f"set {CHECKPOINT_SETTING} to a folder that all executors reach")
        named = tempfile.mkdtemp(prefix="lendscope-")
        atexit.register(shutil.rmtree, named, ignore_errors=True)
        spark.conf.set(CHECKPOINT_SETTING, named)
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared folder; nothing is there yet."""
    return f"{shared_root(spark)}/{label}-{uuid.uuid4().hex}"
