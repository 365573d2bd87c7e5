"""Seen-URL memory as a streaming job: each batch keeps what no earlier batch has seen.

``run`` reads new files, normalises their URLs, drops what the state table
knows, and appends outcome rows and new keys. State rows carry the batch that
wrote them, and a batch that is run again after a failure looks only at older
batches and replaces its own folder, so every row has exactly one outcome.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.functions import urls
from gleanmill.operators.setops import keep_first, unseen
from gleanmill.sources.readers import state

STATE = "url_key string, batch long"


def new_in_batch(rows: DataFrame, history: DataFrame, url: str = "url", pos: str = "pos") -> DataFrame:
    """First row of each key that is not in the history."""
    keyed = rows.withColumn("url_key", urls.seen_key(F.col(url))).filter("url_key <> ''")
    return unseen(keep_first(keyed, F.col("url_key"), pos), "url_key", history)


def run(spark: SparkSession, source: str, schema: str, out: str, checkpoint: str) -> None:
    """Process all files that arrived since the last run, then stop."""

    def batch(rows: DataFrame, number: int) -> None:
        known = state(spark, f"{out}/state", STATE).filter(F.col("batch") < number)
        fresh = new_in_batch(rows, known.select("url_key"))
        fresh.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/rows")
        keys = spark.read.parquet(f"{out}/rows").filter(F.col("batch") == number).select("url_key")
        keys.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(f"{out}/state")

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
