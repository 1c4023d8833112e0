"""Intermediate tables that outlive lost executors."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that all executors share: spark.checkpoint.dir, or that given to setCheckpointDir.

    A cluster without one is an error; only in local mode, as in tests, a temporary one is taken.
    """
    context = spark.sparkContext
    known = context._jsc.sc().getCheckpointDir()
    named = context.getConf().get("spark.checkpoint.dir")
    if named or known.isDefined():
        return named or known.get()
    if not context.master.startswith("local[") and context.master != "local":
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoints-"))
    return context._jsc.sc().getCheckpointDir().get()


def durable(df: DataFrame) -> DataFrame:
    """`df`, computed once and kept in the shared folder; its partitions stay as they are."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
