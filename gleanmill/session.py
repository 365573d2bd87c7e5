"""Session helpers shared by the library."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one table of a data folder; the path may be anything Spark can read."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder the cluster names; fall back to a local one only on a single machine.

    On a cluster ``spark.checkpoint.dir`` must name a folder that driver and
    executors share; without one this is an error.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured is None and not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    context.setCheckpointDir(configured or tempfile.mkdtemp(prefix="gleanmill-checkpoint-"))
