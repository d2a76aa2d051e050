"""Keeping the rows of an iteration in files that all executors can read."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame


def kept(df: DataFrame) -> DataFrame:
    """Checkpoint in the folder of spark.checkpoint.dir; on one machine alone a temporary one if unset."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local[") and context.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="strandline-"))
    return df.checkpoint()
