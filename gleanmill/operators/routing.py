"""Routes of links under the patterns of their own sites, and robots rules as an index of prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmill.functions import urls

#: Prefixes of at most so many signs are shared by many addresses of a host; their rules are laid out in so many copies.
SHORT = 8
COPIES = 16


def with_patterns(links: DataFrame, sites: DataFrame, site: str = "site") -> DataFrame:
    """Links with ``article_url_pattern`` and ``pagination_pattern`` of their site, rows of equal patterns side by side.

    ``sites`` has (domain, article_url_pattern, pagination_pattern), one row per
    domain. A pattern that comes from a column is compiled when it changes, so
    after this order each one is compiled once in a task. Links of other sites have null patterns.
    """
    known = sites.select(urls.domain(F.concat(F.lit("https://"), F.col("domain"))).alias("__gm_domain"), "article_url_pattern", "pagination_pattern")
    joined = links.join(known, F.regexp_replace(F.lower(F.col(site)), r"^www[.]", "") == F.col("__gm_domain"), "left").drop("__gm_domain")
    return joined.sortWithinPartitions("pagination_pattern", "article_url_pattern")


def routed(links: DataFrame, sites: DataFrame, url: str = "url", site: str = "site") -> DataFrame:
    """Links with ``route``: off_domain, pagination, article or none, by the site's patterns where it has them."""
    told = with_patterns(links, sites, site)
    u = F.col(url)
    route = (
        F.when(~urls.same_domain(u, F.col(site)), F.lit("off_domain"))
        .when(urls.pagination_url(u, F.col("pagination_pattern")), F.lit("pagination"))
        .when(urls.article_url(u, F.col("article_url_pattern")), F.lit("article"))
        .otherwise(F.lit("none"))
    )
    return told.withColumn("route", route).drop("article_url_pattern", "pagination_pattern")


def listing_links(pages: DataFrame, sites: DataFrame) -> DataFrame:
    """(page_id, pos, url, route): the first of equal links of each page (page_id, url, html), by its site's patterns.

    ``sites`` also decides what a page's site is: its own domain. Links are in basic form; those that are no page address are left out.
    """
    found = pages.select("page_id", F.col("url").alias("__gm_base"), F.posexplode(urls.links(F.col("html"))).alias("pos", "__gm_link"))
    found = found.select("page_id", "pos", urls.basic(urls.resolve(F.col("__gm_link"), F.col("__gm_base"))).alias("url"), urls.domain(F.col("__gm_base")).alias("site")).filter("url IS NOT NULL")
    first = found.groupBy("page_id", "url", "site").agg(F.min("pos").alias("pos"))
    return routed(first, sites).select("page_id", "pos", "url", "route")


def _copy_of(url: Column) -> Column:
    return F.pmod(F.xxhash64(url), F.lit(COPIES)).cast("int")


def robots_allowed(asked: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """(url, allowed): whether the longest rule of a URL's host that its path begins with allows it; no rule allows.

    ``rules`` has (host, prefix, allow). An address meets the rules by equality of
    host and prefix, for each prefix of its path that is as long as some rule, so a host may have any
    number of rules. Of equal rules with both verdicts the allowing one counts. Each
    different URL comes out once; null URLs and hosts without rules are allowed.
    """
    index = rules.filter(F.col("prefix").isNotNull()).groupBy(F.lower("host").alias("__gm_host"), F.col("prefix").alias("__gm_prefix")).agg(F.max("allow").alias("allow"))
    index = index.withColumn("n", F.char_length("__gm_prefix"))
    lengths = sorted(r["n"] for r in index.select("n").distinct().collect())  # no more than a path is long
    copies = F.when(F.col("n") <= SHORT, F.sequence(F.lit(0), F.lit(COPIES - 1))).otherwise(F.array(F.lit(0)))
    index = index.withColumn("__gm_copy", F.explode(copies))
    once = asked.select(F.col(url).alias("url")).distinct()
    told = once.select("url", urls.host(F.col("url")).alias("__gm_host"), urls.path(F.col("url")).alias("__gm_path"), _copy_of(F.col("url")).alias("__gm_own"))
    every = F.filter(F.array(*map(F.lit, lengths)).cast("array<int>"), lambda n: n <= F.char_length("__gm_path"))
    probes = told.select("url", "__gm_host", "__gm_path", "__gm_own", F.explode(every).alias("n"))
    probes = probes.select("url", "n", "__gm_host", F.left("__gm_path", F.col("n")).alias("__gm_prefix"), F.when(F.col("n") <= SHORT, F.col("__gm_own")).otherwise(0).alias("__gm_copy"))
    hits = probes.join(index, ["__gm_host", "__gm_prefix", "__gm_copy", "n"]).groupBy(F.col("url").alias("__gm_url")).agg(F.max_by("allow", "n").alias("__gm_allow"))
    return once.join(hits, F.col("url") == F.col("__gm_url"), "left").select("url", F.coalesce("__gm_allow", F.lit(True)).alias("allowed"))
