"""Walks over link tables in rounds: listing pages per start, and a frontier of any depth.

A round follows the links of the pages that the round before has found. Its
result is checkpointed, so the plan of a round doesn't hold all earlier ones.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanmill.functions import urls
from gleanmill.functions import constants as C
from gleanmill.operators.ordered import ranked
from gleanmill.session import ensure_checkpoint_dir


def listing_walk(starts: DataFrame, links: DataFrame, max_pages: int = C.MAX_LISTING_PAGES) -> DataFrame:
    """(site, start, url, nth): listing pages that each start visits, first in first out, ``max_pages`` at most.

    ``starts`` has (site, url), ``links`` (src, dst, pos) of pagination links;
    ``max_pages`` 0 sets no bound. Every start of a site walks on its own and may
    visit what another one has visited. The bound acts inside a round: a round
    keeps the pages of a start in the order of its queue while there is room.
    """
    ensure_checkpoint_dir(starts.sparkSession)
    visited = starts.select("site", F.col("url").alias("start"), "url", F.lit(1).cast("long").alias("nth")).filter("url IS NOT NULL").distinct().checkpoint()
    front = visited
    while max_pages != 1 and not front.isEmpty():
        step = front.join(links, F.col("url") == F.col("src")).select("site", "start", F.col("dst").alias("url"), F.struct("nth", "pos").alias("at")).filter("url IS NOT NULL")
        step = step.groupBy("site", "start", "url").agg(F.min("at").alias("at"))
        new = _not_in(step, visited)
        known = visited.groupBy("site", "start").agg(F.max("nth").alias("so_far"))
        same = new["site"].eqNullSafe(known["site"]) & (new["start"] == known["start"])
        queued = new.join(known, same).select(new["site"], new["start"], "url", "at", "so_far")
        nth = F.row_number().over(Window.partitionBy("site", "start").orderBy("at", "url"))
        placed = queued.withColumn("place", nth)
        if max_pages:
            placed = placed.filter(F.col("place") <= max_pages).filter(F.col("so_far") + F.col("place") <= max_pages)
        front = placed.select("site", "start", "url", (F.col("so_far") + F.col("place")).alias("nth")).checkpoint()
        visited = visited.unionByName(front).checkpoint()
    return visited


def _not_in(step: DataFrame, visited: DataFrame) -> DataFrame:
    """Anti-join in which a null site is a site."""
    known = visited.select(F.col("site").alias("__gm_site"), F.col("start").alias("__gm_start"), F.col("url").alias("__gm_url"))
    return step.join(known, F.col("site").eqNullSafe(F.col("__gm_site")) & (F.col("start") == F.col("__gm_start")) & (F.col("url") == F.col("__gm_url")), "left_anti")


def site_articles(walk: DataFrame, starts: DataFrame, links: DataFrame) -> DataFrame:
    """(site, url, rank): articles that a site's visited listings link to, in the order in which they are first seen.

    ``walk`` is the result of ``listing_walk``, ``starts`` has (site, url, pos) with
    the place of each start, ``links`` (src, dst, pos) of article links.
    """
    placed = starts.groupBy(F.col("site").alias("__gm_site"), F.col("url").alias("__gm_start")).agg(F.min("pos").alias("__gm_pos"))
    known = walk.join(placed, F.col("site").eqNullSafe(F.col("__gm_site")) & (F.col("start") == F.col("__gm_start")))
    found = known.join(links, F.col("url") == F.col("src")).select("site", F.col("dst").alias("article"), F.struct(F.col("__gm_pos"), "nth", "pos").alias("at"))
    first = found.filter("article IS NOT NULL").groupBy("site", "article").agg(F.min("at").alias("at"))
    return ranked(first, ["site"], "at").select("site", F.col("article").alias("url"), F.col("rank").cast("long").alias("rank"))


def outcome_of_visit(url: Column, seed_host: Column, known: Column, content_type: Column) -> Column:
    """What becomes of a queued URL: the first test that it fails, else whether it is saved."""
    return (
        F.when(known, F.lit("seen"))
        .when(~F.coalesce(urls.host_raw(url) == seed_host, F.lit(False)), F.lit("off_domain"))
        .when(~urls.suffix_allowed(url), F.lit("suffix"))
        .when(content_type.isNull(), F.lit("error"))
        .when(urls.save_pattern(url), F.lit("saved"))
        .otherwise(F.lit("unmatched"))
    )


#: Columns by which the table of what was met is bucketed and asked.
MET = ("url", "seed_host")


def not_met(step: DataFrame, met: DataFrame) -> DataFrame:
    """Rows of a step that were not met yet; of a table in buckets only the step is shuffled."""
    return step.join(met.select(*MET), list(MET), "left_anti")


def crawl(seeds: DataFrame, pages: DataFrame, edges: DataFrame, max_depth: int, history: DataFrame | None = None, buckets: int | None = None) -> DataFrame:
    """(url, depth, outcome) of every URL that a crawl meets, with its smallest depth.

    ``seeds`` has (url), ``pages`` (url, content_type) of what can be fetched,
    ``edges`` (src, dst), ``history`` (url) of earlier runs. Links are followed from
    pages that were fetched, are of the seed's host and allowed, and whose content
    type says html; whether a page is saved doesn't matter.

    What has been met is a table that is bucketed by URL and seed's host, and every round adds
    its pages to it, so a round shuffles its own links, not all that was met before.
    """
    spark = seeds.sparkSession
    ensure_checkpoint_dir(spark)
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    met = f"gleanmill_met_{uuid.uuid4().hex}"
    known = history.select("url").distinct().withColumn("__gm_known", F.lit(True)) if history is not None else None
    kinds = pages.select(F.col("url").alias("__gm_page"), F.coalesce("content_type", F.lit("")).alias("content_type"))
    front = seeds.filter("url IS NOT NULL").select("url", urls.host_raw(F.col("url")).alias("seed_host")).distinct()
    try:
        for depth in range(max_depth + 1):
            told = front.join(kinds, F.col("url") == F.col("__gm_page"), "left")
            told = told.join(known, "url", "left") if known is not None else told.withColumn("__gm_known", F.lit(None).cast("boolean"))
            outcome = outcome_of_visit(F.col("url"), F.col("seed_host"), F.col("__gm_known").isNotNull(), F.col("content_type"))
            told = told.select("url", "seed_host", F.lit(depth).alias("depth"), outcome.alias("outcome"), F.contains("content_type", F.lit("html")).alias("html"))
            told.write.mode("append").bucketBy(n, *MET).sortBy(*MET).format("parquet").saveAsTable(met)
            if depth == max_depth:
                break
            open_ = spark.table(met).filter((F.col("depth") == depth) & F.col("html") & F.col("outcome").isin("saved", "unmatched"))
            step = open_.join(edges, F.col("url") == F.col("src")).select(F.col("dst").alias("url"), "seed_host").filter("url IS NOT NULL").distinct()
            # The same URL may be off the domain of one seed and on that of another, so both are met.
            front = not_met(step, spark.table(met)).checkpoint()
            if front.isEmpty():
                break
        best = F.min(F.struct(F.col("outcome") == "off_domain", F.col("depth"), F.col("outcome")))
        return spark.table(met).groupBy("url").agg(best.alias("b")).select("url", "b.depth", "b.outcome").checkpoint()
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {met}")
