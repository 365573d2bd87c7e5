"""Unique names, walks and lists by key against loops that go row by row."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gleanmill.operators import names, ordered, walks
from gleanmill.session import ensure_checkpoint_dir


def one_after_the_other(rows, existing=()):
    taken, out = set(existing), {}
    for pos, stem, suffix in sorted(rows):
        name, n = (stem or "") + (suffix or ""), 1
        while name in taken:
            n += 1
            name = f"{stem or ''}_{n}{suffix or ''}"
        taken.add(name)
        out[pos] = name
    return out


STEMS = ["a", "a_2", "a_3", "a_2_2", "a_2_3", "b", "b_2", "a_5", "a_1", "a_02", "", "_2", "a_2_2_2", "a_3_2", "a_99999999999"]
FILES = [("a", ".html"), ("a_4", ".html"), ("b_2", ".pdf"), ("a_2_2", ".html"), ("zz", ".html"), ("a_2", ".pdf")]


@pytest.mark.parametrize("seed, n, with_files", [(0, 40, False), (1, 120, True), (2, 300, False), (3, 250, True)])
def test_names_one_after_the_other(spark, seed, n, with_files):
    r = random.Random(seed)
    rows = [(i, r.choice(STEMS[: 5 + 3 * seed]), r.choice([".html", ".pdf"])) for i in range(n)]
    frame = spark.createDataFrame([(*x, "u", 1) for x in rows], "pos long, stem string, suffix string, unique_name_of string, k int").repartition(3)
    files = spark.createDataFrame(FILES, "stem string, suffix string") if with_files else None
    found = {x.pos: x.unique_name for x in names.unique_names(frame, "stem", "suffix", "pos", files).collect()}
    assert found == one_after_the_other(rows, [a + b for a, b in FILES] if with_files else ())
    assert len(set(found.values())) == n


def test_the_clash_of_a_number_and_an_own_name(spark):
    rows = [(1, "a", ".html"), (2, "a", ".html"), (3, "a_2", ".html"), (4, None, None), (5, None, None), (6, "", "")]
    found = {x.pos: x.unique_name for x in names.unique_names(spark.createDataFrame(rows, "pos long, stem string, suffix string"), "stem", "suffix", "pos").collect()}
    assert found == {1: "a.html", 2: "a_2.html", 3: "a_2_2.html", 4: "", 5: "_2", 6: "_3"}
    assert names.unique_names(spark.createDataFrame([], "pos long, stem string, suffix string"), "stem", "suffix", "pos").count() == 0


def test_a_name_of_a_third_of_all_rows(spark):
    rows = spark.range(9000).select(F.col("id").alias("pos"), F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 9 == 1, F.concat(F.lit("hot_"), (F.col("id") % 500).cast("string"))).otherwise(F.concat(F.lit("x"), F.col("id").cast("string"))).alias("stem"), F.lit("").alias("suffix"))
    found = {x.pos: x.unique_name for x in names.unique_names(rows, "stem", "suffix", "pos").collect()}
    assert found == one_after_the_other([(x.pos, x.stem, x.suffix) for x in rows.collect()])


def walked(starts, links, most):
    out = set()
    after = defaultdict(list)
    for src, dst, _ in sorted(links, key=lambda x: x[2]):
        after[src].append(dst)
    for site, start in set(starts):
        queue, seen = [start], []
        while queue and (not most or len(seen) < most):
            page = queue.pop(0)
            if page in seen:
                continue
            seen.append(page)
            queue += after[page]
        out |= {(site, start, page, i + 1) for i, page in enumerate(seen)}
    return out


@pytest.mark.parametrize("most", [1, 2, 5, 0])
def test_walks_with_a_queue(spark, most):
    r = random.Random(most)
    links = [(f"p{r.randrange(25)}", f"p{r.randrange(25)}", i) for i in range(60)]
    starts = [(r.choice(["s", "t", None]), f"p{r.randrange(25)}") for _ in range(8)]
    frame = walks.listing_walk(spark.createDataFrame(starts + starts[:2], "site string, url string"), spark.createDataFrame(links, "src string, dst string, pos int"), most)
    assert {(x.site, x.start, x.url, x.nth) for x in frame.collect()} == walked(starts, links, most) and frame.count() == len(walked(starts, links, most))


def test_articles_in_the_order_of_listings(spark):
    starts = spark.createDataFrame([("s", "a", 1), ("s", "x", 2), (None, "n", 1)], "site string, url string, pos int")
    pages = spark.createDataFrame([("a", "b", 1), ("x", "y", 1)], "src string, dst string, pos int")
    articles = spark.createDataFrame([("a", "k2", 5), ("a", "k1", 3), ("b", "k1", 1), ("b", "k3", 2), ("x", "k4", 9), ("x", "k2", 1), ("n", "m", 1), ("z", "q", 1)], "src string, dst string, pos int")
    walk = walks.listing_walk(starts.select("site", "url"), pages)
    assert {(x.site, x.url) for x in walk.collect()} == {("s", "a"), ("s", "b"), ("s", "x"), ("s", "y"), (None, "n")}
    found = walks.site_articles(walk, starts, articles).collect()
    assert sorted((x.site or "", x.rank, x.url) for x in found) == [("", 1, "m"), ("s", 1, "k1"), ("s", 2, "k2"), ("s", 3, "k3"), ("s", 4, "k4")]


def test_crawl_by_rounds(spark):
    u = lambda x: f"https://h.test/{x}"
    pages = [(u("a"), "text/html"), (u("b"), "application/pdf"), (u("c"), "text/html; x"), (u("d"), "text/html"), (u("e"), None), (u("news/f"), "TEXT"), ("https://o.test/x", "text/html"), (u("known"), "text/html"), (u("z.exe"), "text/html")]
    edges = [("a", "b"), ("a", "c"), ("b", "never"), ("c", "d"), ("c", "a"), ("d", "e"), ("e", "deep"), ("known", "never"), ("c", "known"), ("a", "z.exe"), ("z.exe", "never"), ("c", "missing")]
    frame = walks.crawl(
        spark.createDataFrame([(u("a"),), (u("a"),), (None,)], "url string"), spark.createDataFrame(pages, "url string, content_type string"),
        spark.createDataFrame([(u(a), u(b)) for a, b in edges] + [(u("a"), "https://o.test/x"), ("https://o.test/x", u("never"))], "src string, dst string"), 3, spark.createDataFrame([(u("known"),)], "url string"),
    )
    found = {x.url.removeprefix("https://h.test/"): (x.depth, x.outcome) for x in frame.collect()}
    assert found == {"a": (0, "unmatched"), "b": (1, "unmatched"), "c": (1, "unmatched"), "z.exe": (1, "suffix"), "https://o.test/x": (1, "off_domain"), "d": (2, "unmatched"), "known": (2, "seen"), "missing": (2, "error"), "e": (3, "unmatched")}
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("gleanmill_met")]


def test_a_round_shuffles_its_own_links_alone(spark):
    rows = spark.range(2000).select(F.concat(F.lit("https://h.test/"), F.col("id").cast("string")).alias("url"), F.concat(F.lit("h"), (F.col("id") % 3).cast("string")).alias("seed_host"))
    rows.write.bucketBy(4, *walks.MET).sortBy(*walks.MET).mode("overwrite").format("parquet").saveAsTable("gleanmill_test_met")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        front = walks.not_met(rows.limit(50), spark.table("gleanmill_test_met"))
        plan = front._jdf.queryExecution().executedPlan().toString()
        scan = plan[plan.index("gleanmill_test_met") - 400 :] if "gleanmill_test_met" in plan else plan
        assert "SelectedBucketsCount: 4 out of 4" in plan and plan.count("Exchange hashpartitioning") == 1, scan
        assert front.count() == 0
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        spark.sql("DROP TABLE gleanmill_test_met")


def test_running_totals_and_chunks(spark):
    r = random.Random(7)
    rows = [(r.choice(["k", "k", "k", "l", None]), i, r.choice([1, 2, None])) for i in range(2000)]
    frame = spark.createDataFrame(rows, "key string, pos int, v int").repartition(9)
    want, total = {}, defaultdict(int)
    for k, i, v in rows:
        want[i] = total[k]
        total[k] += v or 0
    assert {x.pos: x.t for x in ordered.running(frame, ["key"], "pos", F.col("v"), "t", before=True).collect()} == want
    chunks = ordered.lists_in_chunks(frame, ["key"], "pos", "v", 7).collect()
    lists = defaultdict(list)
    for x in sorted(chunks, key=lambda x: x.chunk):
        assert len(x["values"]) <= 7
        lists[x.key] += x["values"]
    assert lists == {k: [v for q, _, v in rows if q == k] for k in ("k", "l", None)}
    texts = ordered.texts_in_chunks(frame.withColumn("v", F.col("v").cast("string")), ["key"], "pos", "v", "--", 7).collect()
    joined = defaultdict(str)
    for x in sorted(texts, key=lambda x: x.chunk):
        joined[x.key] += x.text
    assert joined == {k: "--".join(str(v) for q, _, v in rows if q == k and v) for k in ("k", "l", None)}
    ensure_checkpoint_dir(spark)
    assert ordered.ranked(frame.limit(0), ["key"], "pos").count() == 0
