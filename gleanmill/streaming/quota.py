"""Quota of saved articles per site as a stateful stream that goes on where it stopped.

Rows arrive in files, in the order of their positions. The state of a site is the
number of its articles that count as saved; it lives in the checkpoint, so a run
that is started again after a stop neither visits more than the quota nor
begins anew. Rows that a journal has are not visited again; those that it has
as saved count towards the quota where they stand in the list.

A batch is bounded by its number of files, and so is what a task holds of one site.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from gleanmill.functions import constants as C

#: Columns of the rows that arrive: an article of a site, its place, and whether a visit saves it.
ARTICLES = "site string, pos long, url string, saves boolean"
VISITS = "site string, pos long, url string, status string, saved_before long"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class Quota(StatefulProcessor):
    """Counts what a site has saved and lets rows through until the quota is full."""

    def __init__(self, quota: int) -> None:
        self.quota = quota

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.saved = handle.getValueState("saved", "n long")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        before = self.saved.get()[0] if self.saved.exists() else 0
        if before >= self.quota:
            return
        # A group's key may be null, which is a site of its own.
        batch = pd.concat(list(rows)).sort_values("pos", kind="stable")
        counts = batch["counts"].astype("int64")
        earlier = before + counts.cumsum() - counts
        open_ = earlier < self.quota
        self.saved.update((int(min(self.quota, before + counts[open_].sum())),))
        out = batch[open_]
        yield pd.DataFrame({"site": out["site"], "pos": out["pos"], "url": out["url"], "status": out["status"], "saved_before": earlier[open_]})

    def close(self) -> None:
        pass


def told(rows: DataFrame, journal: DataFrame | None) -> DataFrame:
    """Rows with their status (journal, saved or visited) and what they count towards the quota."""
    if journal is None:
        rows = rows.withColumn("__gm_status", F.lit(None).cast("string"))
    else:
        known = journal.groupBy(F.col("url").alias("__gm_url")).agg(F.max_by("status", F.col("status") == "saved").alias("__gm_status"))
        rows = rows.join(known, F.col("url") == F.col("__gm_url"), "left").drop("__gm_url")
    noted = F.col("__gm_status").isNotNull()
    saves = F.coalesce("saves", F.lit(False))
    status = F.when(noted, F.lit("journal")).when(saves, F.lit("saved")).otherwise(F.lit("visited"))
    counts = F.when(noted, F.col("__gm_status") == "saved").otherwise(saves)
    return rows.select("site", "pos", "url", status.alias("status"), counts.cast("long").alias("counts"))


def run(spark: SparkSession, source: str, out: str, checkpoint: str, journal: DataFrame | None = None, quota: int = C.MAX_ARTICLES_PER_SITE, files: int = 8) -> None:
    """Take all files that arrived since the last run, ``files`` a batch, append the rows that are met before a site is full, then stop."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, _STORE)
    try:
        rows = told(spark.readStream.schema(ARTICLES).option("maxFilesPerTrigger", files).parquet(source), journal)
        visits = rows.groupBy("site").transformWithStateInPandas(Quota(quota), VISITS, "Append", "None")
        stream = visits.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
        stream.awaitTermination()
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)
