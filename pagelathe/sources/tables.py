"""Reading the tables, and the place for intermediate results."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The Parquet table `name` in `folder`."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def use_checkpoints(spark: SparkSession) -> None:
    """Make sure that checkpoint() has a folder: the shared one that spark.checkpoint.dir names.

    Where it is unset, a local folder is made if the session runs on this
    machine alone, as in tests; on a cluster a RuntimeError says what to set.
    """
    context = spark.sparkContext
    if context._jsc.sc().getCheckpointDir().isDefined():
        return
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        shared = os.path.join(tempfile.gettempdir(), f"checkpoints-{uuid.uuid4().hex}")
    context.setCheckpointDir(shared)
