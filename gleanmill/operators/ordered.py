"""Running totals, ranks and lists by key for keys of any size.

A window over a key sorts all rows of the key in one task. Here rows are dealt by
ranges of key and position, so that a large key covers several partitions. Each
partition of a key is a cell; totals of cells are few, and a row's running total
is that of the cells before plus that inside its own cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanmill.session import ensure_checkpoint_dir


def running(rows: DataFrame, keys: list[str], pos: str, value: Column, name: str, before: bool = False) -> DataFrame:
    """Rows with the sum of ``value`` over the rows of the same key up to their position.

    Positions are unique within a key; with ``before`` the row itself doesn't
    count. Null values count 0, null keys are a key of their own.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    keyed = rows.withColumn("__gm_key", F.struct(*keys)).withColumn("__gm_value", F.coalesce(value.cast("long"), F.lit(0).cast("long")))
    # Partitions are told by their number, so they must not be dealt anew.
    placed = keyed.repartitionByRange("__gm_key", F.col(pos)).withColumn("__gm_part", F.spark_partition_id()).checkpoint()
    cells = placed.groupBy("__gm_key", "__gm_part").agg(F.sum("__gm_value").alias("__gm_sum"))
    earlier = Window.partitionBy("__gm_key").orderBy("__gm_part").rowsBetween(Window.unboundedPreceding, -1)  # a row per partition at most
    offsets = cells.select("__gm_key", "__gm_part", F.coalesce(F.sum("__gm_sum").over(earlier), F.lit(0)).alias("__gm_before"))
    inside = Window.partitionBy("__gm_key", "__gm_part").orderBy(pos).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = placed.withColumn("__gm_inside", F.sum("__gm_value").over(inside)).join(offsets, ["__gm_key", "__gm_part"])
    total = F.col("__gm_before") + F.col("__gm_inside") - (F.col("__gm_value") if before else F.lit(0))
    return summed.withColumn(name, total).drop("__gm_key", "__gm_value", "__gm_part", "__gm_inside", "__gm_before")


def ranked(rows: DataFrame, keys: list[str], pos: str, name: str = "rank") -> DataFrame:
    """Rows with their place, from 1, among the rows of their key."""
    return running(rows, keys, pos, F.lit(1), name)


def lists_in_chunks(rows: DataFrame, keys: list[str], pos: str, value: str, size: int, name: str = "values") -> DataFrame:
    """(keys, chunk, values): the values of each key in order of position, ``size`` at most in a row.

    Chunks are numbered from 0 and joined in that order they are the key's whole
    list, so no row grows with a key. Null values keep their places.
    """
    placed = ranked(rows.select(*keys, pos, value), keys, pos, "__gm_rank").withColumn("chunk", F.floor((F.col("__gm_rank") - 1) / size).cast("long"))
    inside = F.struct(F.col("__gm_rank").alias("r"), F.col(value).alias("v"))
    lists = placed.groupBy(*keys, "chunk").agg(F.sort_array(F.collect_list(inside)).alias("__gm_list"))
    return lists.select(*keys, "chunk", F.transform("__gm_list", lambda x: x["v"]).alias(name))


def texts_in_chunks(rows: DataFrame, keys: list[str], pos: str, value: str, separator: str, size: int, name: str = "text") -> DataFrame:
    """(keys, chunk, text): the joined texts of each key in order, ``size`` values at most in a row; null values are left out.

    All chunks of a key but the last end with the separator, so that set one after
    the other they are the key's whole text.
    """
    rows = rows.filter(F.col(value).isNotNull())
    parts = lists_in_chunks(rows, keys, pos, value, size, "__gm_parts")
    last = parts.groupBy(*[F.col(k).alias(f"__gm_{k}") for k in keys]).agg(F.max("chunk").alias("__gm_last"))
    same = [F.col(k).eqNullSafe(F.col(f"__gm_{k}")) for k in keys]
    joined = parts.join(last, same)
    tail = F.when(F.col("chunk") < F.col("__gm_last"), F.lit(separator)).otherwise(F.lit(""))
    return joined.select(*keys, "chunk", F.concat(F.array_join("__gm_parts", separator), tail).alias(name))
