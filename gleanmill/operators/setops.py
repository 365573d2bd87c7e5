"""Joins, deduplication, ranking and numbering.

"First" always means the smallest value of an explicit position column; nothing
here depends on the order of partitions. Windows are partitioned by a key; the
few global numberings go through ``numbered``, which has no single-task sort.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gleanmill.functions import constants as C
from gleanmill.functions import urls
from gleanmill.operators.ordered import running
from gleanmill.session import ensure_checkpoint_dir


def numbered(rows: DataFrame, pos: str, name: str = "n") -> DataFrame:
    """Consecutive numbers from 1 in the order of ``pos``, without sorting all rows in one task.

    A range partitioning by a sample of ``pos`` puts about as many rows into each
    task, however sparse the positions are; a row's number is its place in its
    partition plus the rows of the partitions before, of which there is one count
    each. The sorted rows are checkpointed, so that places and counts agree.
    """
    ensure_checkpoint_dir(rows.sparkSession)
    placed = rows.repartitionByRange(pos).sortWithinPartitions(pos).withColumn("__gm_at", F.monotonically_increasing_id()).checkpoint()
    part, place = F.shiftright("__gm_at", 33), F.col("__gm_at").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = placed.groupBy(part.alias("__gm_q")).agg(F.count(F.lit(1)).alias("__gm_c"))
    before = Window.orderBy("__gm_q").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__gm_q", F.coalesce(F.sum("__gm_c").over(before), F.lit(0)).alias("__gm_o"))  # one row per partition
    joined = placed.join(F.broadcast(offsets), part == F.col("__gm_q"))
    return joined.withColumn(name, (F.col("__gm_o") + place + 1).cast("long")).drop("__gm_at", "__gm_q", "__gm_o")


def keep_first(rows: DataFrame, key: Column, pos: str) -> DataFrame:
    """The first row of each key."""
    order = Window.partitionBy("__gm_key").orderBy(pos)
    return rows.withColumn("__gm_key", key).withColumn("__gm_rn", F.row_number().over(order)).filter("__gm_rn = 1").drop("__gm_key", "__gm_rn")


def dedupe_ranked(rows: DataFrame, url: str, pos: str) -> DataFrame:
    """First row of each seen key, ranked anew from 1; rows without a key go."""
    keyed = rows.withColumn("url_key", urls.seen_key(F.col(url))).filter("url_key <> ''")
    return numbered(keep_first(keyed, F.col("url_key"), pos), pos, "rank")


def mark_first(rows: DataFrame, key: str, pos: str, name: str) -> DataFrame:
    """A flag for the row of each key with its smallest position (positions are unique).

    The smallest positions are combined before the shuffle and joined back, so
    that a key with a large share of the rows can be split over tasks.
    """
    first = rows.groupBy(F.col(key).alias("__gm_k")).agg(F.min(pos).alias("__gm_first"))
    return rows.join(first, F.col(key) == F.col("__gm_k")).withColumn(name, F.col(pos) == F.col("__gm_first")).drop("__gm_k", "__gm_first")


def exclude_then_dedupe(rows: DataFrame, url: str, pos: str) -> DataFrame:
    """Every row with an outcome: excluded, duplicate or kept; excluded rows are told before duplicates.

    Whether a row is excluded depends on its key alone, so equal keys share it.
    """
    marked = mark_first(rows.withColumn("url_key", urls.canonical(F.col(url))).filter("url_key <> ''"), "url_key", pos, "__gm_one")
    outcome = F.when(urls.excluded(F.col("url_key")), F.lit("excluded")).when(F.col("__gm_one"), F.lit("kept")).otherwise(F.lit("duplicate"))
    return marked.withColumn("outcome", outcome).drop("__gm_one")


def unseen(rows: DataFrame, key: str, *histories: DataFrame) -> DataFrame:
    """Rows whose key is in none of the histories (frames with a column of the same name)."""
    known = reduce(DataFrame.unionByName, [h.select(key) for h in histories]).filter(F.col(key).isNotNull()).distinct()
    return rows.join(known, key, "left_anti")


def seen(rows: DataFrame, key: str, history: DataFrame) -> DataFrame:
    return rows.join(history.select(key).distinct(), key, "left_semi")


def filter_results(rows: DataFrame, url: str, pos: str, history: DataFrame) -> DataFrame:
    """New results: normal form, no redirects, no blocked hosts, first of each key, not in the history (url_key)."""
    keyed = rows.withColumn("url_key", urls.seen_key(F.col(url))).filter("url_key <> ''")
    fresh = keyed.filter(~urls.is_redirect(F.col("url_key")) & (urls.host(F.col("url_key")) != C.SEARCH_HOST))
    return unseen(keep_first(fresh, F.col("url_key"), pos), "url_key", history)


def union_in_order(*parts: DataFrame, pos: str = "pos") -> DataFrame:
    """All rows of all parts; ``part_pos`` orders them part by part."""
    tagged = [p.withColumn("part_pos", F.struct(F.lit(i).alias("part"), F.col(pos).alias("pos"))) for i, p in enumerate(parts)]
    return reduce(DataFrame.unionByName, tagged)


def site_queries(sources: DataFrame, groups: list[list[str]]) -> DataFrame:
    """One query per source: the product of the sources with one topic."""
    topic = F.array(*[F.array(*map(F.lit, g)) for g in groups])
    return sources.withColumn("query", urls.site_query(F.col("domain"), topic))


def lookup(rows: DataFrame, directory: DataFrame, keys: list[str], pos: str) -> DataFrame:
    """First directory entry for each row; missing phone and mail are told as such."""
    first = keep_first(directory, F.struct(*keys), pos).drop(pos)
    joined = rows.join(first, keys, "left")
    return joined.withColumn("tel", F.coalesce("tel", F.lit("phone vide"))).withColumn("mail", F.coalesce("mail", F.lit("mail vide")))


def lookup_outcome(name: Column, tel: Column, mail: Column) -> Column:
    """How a lookup ended: without a name nothing can be asked."""
    found = (tel != "phone vide") | (mail != "mail vide")
    return F.when(F.trim(F.coalesce(name, F.lit(""))) == "", F.lit("missing_name")).when(found, F.lit("found")).otherwise(F.lit("not_found"))


def split_by_blob(rows: DataFrame, blobs: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """(rows with a blob, rows without)."""
    names = blobs.select(key).distinct()
    return rows.join(names, key, "left_semi"), rows.join(names, key, "left_anti")


def first_source(rows: DataFrame, key: str, priority: str) -> DataFrame:
    """Rows of the best source that answered at all, for each key."""
    best = rows.groupBy(F.col(key).alias("__gm_k")).agg(F.min(priority).alias("__gm_best"))
    return rows.join(best, F.col(key).eqNullSafe(F.col("__gm_k")) & (F.col(priority) == F.col("__gm_best"))).drop("__gm_k", "__gm_best")


def insert_new(table: DataFrame, rows: DataFrame, key: str, pos: str) -> DataFrame:
    """Table after an insert that ignores known keys; of equal new keys the first wins."""
    new = unseen(keep_first(rows, F.col(key), pos), key, table)
    return table.unionByName(new.select(*table.columns))


def top_per_group(rows: DataFrame, group: str, pos: str, k: int) -> DataFrame:
    """First k rows of each group, with their rank."""
    order = Window.partitionBy(group).orderBy(pos)
    return rows.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def first_rows(rows: DataFrame, pos: str, k: int) -> DataFrame:
    return rows.orderBy(pos).limit(k)


def visited_under_quota(rows: DataFrame, group: str, pos: str, saved: str, quota: int = C.MAX_ARTICLES_PER_SITE) -> DataFrame:
    """Rows visited before a group has its quota of saved rows; a group of any size is spread over tasks."""
    return running(rows, [group], pos, F.col(saved).cast("long"), "saved_before", before=True).filter(F.col("saved_before") < quota)


def next_index(names: DataFrame, column: str) -> DataFrame:
    """One row: one more than the largest n of names like ``page_n.suffix``."""
    n = F.nullif(F.regexp_extract(column, r"^page_(\d+)\..+$", 1), F.lit("")).cast("long")
    return names.agg((F.coalesce(F.max(n), F.lit(0)) + 1).alias("next_index"))


def number_successes(rows: DataFrame, pos: str, ok: str, offset: int = 1) -> DataFrame:
    """File numbers of successes in order; failures have none and use none up."""
    good = numbered(rows.filter(F.col(ok)), pos, "__gm_n").withColumn("file_index", F.col("__gm_n") + offset - 1).drop("__gm_n")
    return good.unionByName(rows.filter(~F.coalesce(F.col(ok), F.lit(False))).withColumn("file_index", F.lit(None).cast("long")))


def grouped_in_order(rows: DataFrame, key: Column, pos: str, value: str, name: str) -> DataFrame:
    """Values of each key in order. A key's values form one row, so a key should not hold a large share of all rows."""
    return rows.groupBy(key.alias("key")).agg(F.sort_array(F.collect_list(F.struct(pos, value))).alias("__gm_v")).select("key", F.transform("__gm_v", lambda v: v[value]).alias(name))


def outcome_counts(rows: DataFrame, outcome: str, names: list[str]) -> DataFrame:
    """One row with a count per outcome, zeros included; counted where the rows are read."""
    return rows.agg(F.count(F.lit(1)).alias("total"), *[F.count_if(F.col(outcome) == n).alias(n) for n in names])


def reachable(seeds: DataFrame, edges: DataFrame, max_depth: int) -> DataFrame:
    """(url, depth): pages reached from the seeds over edges (src, dst) of pages that hold links.

    Every page counts once, with its smallest depth.
    """
    found = seeds.select("url", F.lit(0).alias("depth")).distinct()
    front = found
    for depth in range(1, max_depth + 1):
        step = front.join(edges, F.col("url") == F.col("src")).select(F.col("dst").alias("url")).distinct()
        front = step.join(found.select("url"), "url", "left_anti").select("url", F.lit(depth).alias("depth"))
        found = found.unionByName(front)
    return found
