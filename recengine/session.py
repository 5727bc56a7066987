"""Session helpers.

Library operators never create a session; they take DataFrames. These helpers exist for
tests, the bench and the job entry points, and for the one place where lineage must be cut
(a reliable checkpoint under ``spark.checkpoint.dir``).
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark's own setting: the shuffle files of a SQL execution go when it ends, not when the driver next collects its garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Files of a saved table for each task slot. On a file system without Hadoop's native code every file starts processes of its executor,
#: which share the executor's memory for a moment.
FILES_PER_SLOT = 1


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8,
                  app: str = "recengine", driver_memory: str = "8g",
                  advisory_partition_size: str = "64m") -> SparkSession:
    """A local session for tests and the bench (UI off, UTC, AQE on)."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory_partition_size)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", driver_memory)
        # checkpoint files go when their frame is no longer referenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, configuring the context if needed.

    The directory is read from the context or from ``spark.checkpoint.dir``. Only a local
    session without one gets a fresh directory of its own (tests, bench); on a cluster a
    missing setting is an error, because a machine-local folder would not survive the loss
    of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if not configured:
        if not (sc.master == "local" or sc.master.startswith("local[")):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder of the cluster")
        configured = tempfile.mkdtemp(prefix="recengine-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable_checkpoint(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and cut its lineage (eager).

    The frame is persisted while it is written, so writing it does not compute it twice.
    """
    from pyspark import StorageLevel
    ensure_checkpoint_dir(df.sparkSession)
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return df.checkpoint(eager=True)
    finally:
        df.unpersist()


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Executions inside delete their shuffle files as they end; a frame that is run a second time makes them again."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


def free_unused(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files and blocks that nothing refers to any more."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def saved(df: DataFrame, tag: str, path: str | None = None) -> DataFrame:
    """``df`` as a parquet table in the shared folder (added to the one at ``path``), which survives the loss of executors. Unlike a
    checkpointed or persisted frame it is compressed, takes no memory, and the shuffle files that made it are gone.
    The table stays as long as the folder."""
    spark = df.sparkSession
    path = path or shared_path(spark, tag)
    files = FILES_PER_SLOT * max(1, spark.sparkContext.defaultParallelism)
    with freed_shuffles(spark):
        df.coalesce(files).write.mode("append").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def in_rounds(spark: SparkSession, rounds: int, part: Callable[[int], DataFrame], tag: str) -> DataFrame:
    """The union of ``part(0)`` to ``part(rounds - 1)``, each run and saved before the next one begins, so that the shuffle files of
    one round are on disk at a time. A single round is left as it is (and not run)."""
    if rounds <= 1:
        return part(0)
    path = shared_path(spark, tag)
    for i in range(rounds):
        out = saved(part(i), tag, path)
    return out


def shared_path(spark: SparkSession, tag: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def drop_path(spark: SparkSession, path: str) -> None:
    """Deletes a table of ``shared_path`` that is no longer read."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)
