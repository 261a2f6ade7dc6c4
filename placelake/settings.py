"""Where a job may keep intermediate tables."""

from __future__ import annotations

import tempfile
from functools import cache
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared folder, ``spark.checkpoint.dir`` or the context's checkpoint directory.

    Only a local session without that setting gets a folder of its own; a cluster without it
    is refused, as a folder of one machine would be lost with that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that every executor can reach")
    return _local_root(spark.sparkContext.applicationId)


@cache
def _local_root(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"placelake-{application}-")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_root(spark)}/{label}-{uuid4().hex}"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder and read it back, so that later jobs start from it."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
