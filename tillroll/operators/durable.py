"""Materialised intermediates that survive the loss of executors."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local master may run without that setting; it then uses a folder of
    its own. A cluster without it is an error: a machine-local folder is lost
    with its machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if context.master.split("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-"))
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder."""
    return f"{shared_folder(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, label: str = "step") -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and scan it back.

    One execution, no lineage: later uses all see the same rows, even where the
    plan holds a partition-dependent expression.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
