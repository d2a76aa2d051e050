"""Cutting lineage through files that every executor can read."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> None:
    """Use the folder named in spark.checkpoint.dir; on one machine alone, a temporary one if unset."""
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="strandline-checkpoint-")
    context.setCheckpointDir(named)


def cut(df: DataFrame) -> DataFrame:
    """The same rows, read from the shared checkpoint folder from now on.

    Spark deletes the files once nothing refers to the rows, if spark.cleaner.referenceTracking.cleanCheckpoints
    is true when the session starts (session.SETTINGS has it); else they stay until the folder is emptied.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def release(spark: SparkSession) -> None:
    """Let Spark delete now the shuffle files and checkpoints that nothing refers to any more.

    It does so when the driver's JVM collects garbage, which on a driver with memory to spare may be never.
    """
    spark.sparkContext._jvm.System.gc()


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder that Spark wrote, in whatever store it is."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


#: What one Arrow batch sent to Python may hold, as texts can be long.
BATCH_ROWS, BATCH_BYTES = 1000, 8 << 20


def bound_batches(spark: SparkSession) -> None:
    """Lower the session's limits of Arrow batches, where they are higher, so that Python's memory is bounded."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        key = f"spark.sql.execution.arrow.{name}"
        if not 0 < int(spark.conf.get(key).rstrip("b")) <= most:
            spark.conf.set(key, str(most))


def map_arrow(df: DataFrame, function: Callable, schema: str) -> DataFrame:
    """mapInArrow over batches of bounded size."""
    bound_batches(df.sparkSession)
    return df.mapInArrow(function, schema)
