"""State tables by hash bucket: new values of a few keys rewrite the buckets of these keys alone.

A table is a folder with a partition per bucket of a key's hash. An update
reads the buckets that its keys fall into, merges, writes the result beside the table
and then puts it in the place of these buckets; files of all other buckets stay.
A run that stops before the last step leaves the table as it was, and may be run again.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.session import ensure_checkpoint_dir

BUCKETS = 64


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def create(rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> None:
    """Write a state table anew; keys are unique and not null."""
    _write(rows.withColumn("bucket", bucket_of(key, buckets)), path, "overwrite", "static")


def _write(rows: DataFrame, path: str, mode: str, overwrite: str) -> None:
    # One file for each bucket; keys are unique, so hashing keeps buckets even.
    rows.repartition("bucket").write.mode(mode).option("partitionOverwriteMode", overwrite).partitionBy("bucket").parquet(path)


def load(spark: SparkSession, path: str) -> DataFrame:
    """All rows of a table, without their buckets."""
    return spark.read.parquet(path).drop("bucket")


def update(spark: SparkSession, path: str, values: DataFrame, key: str, buckets: int = BUCKETS, insert: bool = False) -> list[int]:
    """Set the columns of ``values`` (key and some columns of the table) where the table has the key; returns the buckets written.

    Null values leave a column as it is. Keys that the table does not have are left out, or,
    with ``insert``, become rows whose other columns are null. Of equal keys in
    ``values`` any one counts, so they should be unique; null keys are left out.
    """
    ensure_checkpoint_dir(spark)
    columns = [c for c in values.columns if c != key]
    new = values.filter(F.col(key).isNotNull()).dropDuplicates([key]).withColumn("bucket", bucket_of(key, buckets)).checkpoint()
    touched = sorted(r["bucket"] for r in new.select("bucket").distinct().collect())  # at most ``buckets`` numbers
    if not touched:
        return []
    table = spark.read.parquet(path)
    old = table.filter(F.col("bucket").isin(touched))  # prunes the folders of all other buckets
    fresh = new.select(F.col(key).alias("__gm_key"), F.col("bucket").alias("__gm_bucket"), *[F.col(c).alias(f"__gm_{i}") for i, c in enumerate(columns)])
    joined = old.join(fresh, (F.col(key) == F.col("__gm_key")) & (F.col("bucket") == F.col("__gm_bucket")), "full" if insert else "left")
    merged = joined.select(*[
        F.coalesce(F.col("__gm_key") if c == key and insert else F.col(c), F.col(c)).alias(c) if c == key
        else F.coalesce("bucket", "__gm_bucket").alias(c) if c == "bucket"
        else F.coalesce(F.col(f"__gm_{columns.index(c)}").cast(table.schema[c].dataType), F.col(c)).alias(c) if c in columns
        else F.col(c)
        for c in table.columns
    ])
    if not insert:
        hit = old.join(fresh, (F.col(key) == F.col("__gm_key")) & (F.col("bucket") == F.col("__gm_bucket")), "left_semi").select("bucket").distinct()
        touched = sorted(r["bucket"] for r in hit.collect())
        merged = merged.filter(F.col("bucket").isin(touched)) if touched else merged.limit(0)
        if not touched:
            return []
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    merged.write.parquet(beside)
    _write(spark.read.schema(merged.schema).parquet(beside), path, "overwrite", "dynamic")
    files = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(beside)
    files.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(files, True)
    return touched
