"""Intermediate tables of narrow rows."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

#: Partitions of a shuffle whose narrow rows one task reads.
TOGETHER = 8


def kept(frame: DataFrame) -> DataFrame:
    """A checkpointed frame of narrow rows (ids, counts, names), read by an eighth of the tasks of a shuffle.

    The number of shuffle partitions is set for texts; tables of ids that come out
    of one would be read and shuffled again on as many nearly empty files.
    """
    tasks = int(frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return frame.checkpoint().coalesce(max(TOGETHER, tasks // TOGETHER))


def side(frame: DataFrame) -> DataFrame:
    """A side of a join of narrow rows that is shuffled at any size.

    Both sides are shuffled by then; if the smaller one were broadcast after that,
    as its size would have it, it would be one more job and one more table in the driver.
    """
    return frame.hint("merge")


def release(spark: SparkSession) -> None:
    """Drop what finished steps hold: broadcasts and jobs in the driver, shuffle files and checkpoints on disk.

    Spark lets go of them when the driver happens to collect its garbage, which a job of many small steps can
    put off until its heap is full. Frames that only a cycle in Python still holds go first.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
