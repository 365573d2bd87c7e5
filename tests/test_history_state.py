"""Large histories, bucketed state, site patterns, robots rules, long keyword lists and the quota stream."""

import random
import re
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from gleanmill.functions import text, urls
from gleanmill.operators import history, html_trees, keywords, routing, setops
from gleanmill.plans import pipelines
from gleanmill.sources import buckets
from gleanmill.streaming import quota
from tests.conftest import DATA


def test_bloom_filter_never_misses(spark):
    known = spark.range(0, 60000, 3).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"))
    words = history.words_for(20000)
    bloom = history.build(known.unionByName(spark.createDataFrame([(None,)], "key string")), "key", words)
    asked = spark.range(60000).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("key"), (F.col("id") % 3 == 0).alias("there"), F.lit(1).alias("word"))
    told = {(r.there, r.maybe_seen): r.n for r in history.marked(asked, "key", bloom, words).groupBy("there", "maybe_seen").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert told[True, True] == 20000 and (True, False) not in told and told[False, True] < 0.06 * 40000
    halves = [known.filter(F.crc32("key") % 2 == i) for i in (0, 1)]
    merged = history.merge(*[history.build(h, "key", words) for h in halves])
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, history.build(known, "key", words).collect()))


@pytest.mark.parametrize("words", [None, history.BUCKETS, 1 << 14])
def test_anti_join_behind_a_filter(spark, words):
    rows = spark.createDataFrame([(i, i % 700 if i % 50 else None, "x") for i in range(3000)], "n int, key int, bits string").repartition(4)
    known = spark.createDataFrame([(i,) for i in range(0, 900, 2)] * 3 + [(None,)], "key int")
    got = history.unseen(rows, "key", known, words)
    assert sorted(r.n for r in got.collect()) == [i for i in range(3000) if i % 50 == 0 or (i % 700) % 2]
    assert history.unseen(rows, "key", known.limit(0), words).count() == 3000 and history.unseen(rows.limit(0), "key", known, words).count() == 0


def test_only_candidates_are_shuffled(spark):
    """Of rows that are surely new none takes part in an exchange."""
    orders, lines = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("orders", "lineitem"))
    known = lines.select(F.col("l_orderkey").alias("key"))
    rows = orders.select((F.col("o_orderkey") + 10_000_000).alias("key"))
    words = history.words_for(known.count())
    told = history.marked(rows, "key", history.build(known, "key", words), words)
    assert told.filter("maybe_seen").count() < 0.06 * rows.count()
    plan = told.filter("NOT maybe_seen")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert history.unseen(rows, "key", known, words).count() == rows.count()


def files_of(path):
    return {p.parent.name: sorted(x.name for x in p.parent.glob("*.parquet")) for p in Path(path).rglob("*.parquet")}


def test_an_update_leaves_other_buckets_alone(spark, tmp_path):
    path = str(tmp_path / "state")
    rows = spark.range(500).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("uuid"), F.lit(None).cast("double").alias("score"), (F.col("id") * 2).alias("other"))
    buckets.create(rows, path, "uuid", 16)
    first = files_of(path)
    assert len(first) == 16 and buckets.load(spark, path).count() == 500
    touched = buckets.update(spark, path, spark.createDataFrame([("u7", 0.5), ("none", 0.9), (None, 1.0)], "uuid string, score double"), "uuid", 16)
    second = files_of(path)
    assert len(touched) == 1 and {b for b in first if first[b] != second[b]} == {f"bucket={touched[0]}"}
    assert {r.uuid: r.score for r in buckets.load(spark, path).filter("score IS NOT NULL").collect()} == {"u7": 0.5}
    assert buckets.update(spark, path, spark.createDataFrame([("nobody", 1.0)], "uuid string, score double"), "uuid", 16) == [] and files_of(path) == second
    buckets.update(spark, path, spark.createDataFrame([("new", 1.0), ("u8", 2.0), ("u7", None)], "uuid string, score double"), "uuid", 16, insert=True)
    found = {r.uuid: (r.score, r.other) for r in buckets.load(spark, path).collect()}
    assert len(found) == 501 and found["new"] == (1.0, None) and found["u8"] == (2.0, 16) and found["u7"] == (0.5, 14)
    assert sorted(p.name for p in tmp_path.iterdir()) == ["state"]


def test_routes_by_the_patterns_of_a_site(spark):
    sites = spark.createDataFrame([("a.test", r"/n/\d+", r"[?]seite="), ("www.b.test", None, None), ("c.test", "/Story", None)], "domain string, article_url_pattern string, pagination_pattern string")
    rows = [
        ("https://www.a.test/n/12", "a.test", "article"), ("https://a.test/x?seite=2", "www.A.test", "pagination"), ("https://a.test/page/2", "a.test", "none"), ("https://b.test/page/2", "b.test", "pagination"),
        ("https://b.test/long-title", "b.test", "article"), ("https://c.test/STORY-one", "c.test", "article"), ("https://c.test/page/3", "c.test", "pagination"), ("https://c.test/other", "c.test", "none"),
        ("https://d.test/other", "d.test", "article"), ("https://d.test/other", "c.test", "off_domain"), ("https://a.test/n/1.pdf", "a.test", "none"),
    ]
    got = routing.routed(spark.createDataFrame([(*r, "p") for r in rows], "url string, site string, want string, article_url_pattern_of string"), sites)
    assert [(r.url, r.route) for r in got.collect() if r.route != r.want] == [] and got.count() == len(rows)


def test_robots_rules_of_any_number(spark):
    r = random.Random(3)
    part = lambda: "/" + "".join(r.choice("abcd") for _ in range(r.randint(1, 3)))
    rules = [("h.test", "".join(part() for _ in range(r.randint(1, 4))), r.random() < 0.5) for _ in range(4000)] + [("h.test", "/", True), ("H.test", "/a", False), ("o.test", "/", False), ("o.test", None, True), ("h.test", "", True)]
    rules = list({(h.lower(), p): (h, p, a) for h, p, a in rules}.values())
    asked = [f"https://{r.choice(['h.test', 'H.TEST', 'o.test', 'n.test'])}{''.join(part() for _ in range(r.randint(0, 6)))}{r.choice(['', '?q=/ab', '/'])}" for _ in range(800)] + [None, "https://h.test", "x"]
    got = {x.url: x.allowed for x in routing.robots_allowed(spark.createDataFrame([(u,) for u in asked + asked[:5]], "url string"), spark.createDataFrame(rules, "host string, prefix string, allow boolean")).collect()}
    assert set(got) == set(asked)
    for u in asked:
        m = re.match(r"https://([^/?]*)([^?]*)", u or "")
        hits = [(len(p), a) for h, p, a in rules if m and p is not None and h.lower() == m[1].lower() and m[2].startswith(p)]
        assert got[u] == (max(hits)[1] if hits else True)


def test_robots_rules_of_one_host(spark):
    rules = spark.range(100_000).select(F.lit("h.test").alias("host"), F.concat(F.lit("/p/"), F.col("id").cast("string"), F.lit("/")).alias("prefix"), (F.col("id") % 2 == 0).alias("allow"))
    asked = spark.range(0, 100_000, 7).select(F.concat(F.lit("https://h.test/p/"), F.col("id").cast("string"), F.lit("/x")).alias("url"), F.col("id"))
    wrong = routing.robots_allowed(asked, rules).join(asked, "url").filter(F.col("allowed") != (F.col("id") % 2 == 0))
    assert wrong.count() == 0


def test_keyword_lists_as_the_native_ones(spark):
    words = ["the", "und", "ing that", "aa", "a", "the", "zzz", "é", ""]
    rows = spark.createDataFrame([(1, "The theme: AAAAA und é"), (2, ""), (3, None), (4, "aaa the" * 300), (5, "ing thating that")], "id int, t string")
    real = words[:-1]
    got = {r.id: (r.score, r.found) for r in keywords.scored(rows, F.col("t"), real, ["id"]).collect()}
    assert got == {r.id: (r.s, r.f) for r in rows.select("id", text.keyword_score(F.col("t"), real).alias("s"), text.keywords_found(F.col("t"), real).alias("f")).collect()}
    more = {r.id: r.found for r in keywords.scored(rows, F.col("t"), words, ["id"]).collect()}  # an empty keyword never occurs
    assert more == {i: f for i, (_, f) in got.items()} and keywords.scored(rows, F.col("t"), [], ["id"]).first().score == 0.0
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    few = ["the", "und", "pour", "tion", "que", "heit", "ment", "zzz", "ing that", "mente"]
    both = keywords.scored(docs, F.col("text"), few, ["doc_id"]).join(docs.select("doc_id", text.keyword_score(F.col("text"), few).alias("native"), text.keywords_found(F.col("text"), few).alias("words")), "doc_id")
    assert both.filter("score <> native OR found <> words").count() == 0


def test_pages_are_scored_alike_by_either_way(spark, monkeypatch):
    pages = spark.read.parquet(f"{DATA}/pages.parquet").withColumn("html", F.when(F.col("page_id") % 9 != 4, F.col("html")))
    words = ["the", "und", "tion", "que", "zzz", "ing that", "the"]
    native = sorted(map(tuple, pipelines.score_pages(pages, words).collect()))
    monkeypatch.setattr(pipelines, "MANY_KEYWORDS", 2)
    assert sorted(map(tuple, pipelines.score_pages(pages, words).collect())) == native and {r[-1] for r in native} >= {"missing_blob"}


def test_five_thousand_keywords(spark):
    """One pass is far faster than one pass per keyword, of which only a tenth is timed here."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").repartition(4).cache()
    docs.count()
    words = [r.w for r in docs.select(F.explode(F.split(F.lower("text"), " ")).alias("w")).filter("length(w) > 2").groupBy("w").count().orderBy(F.desc("count"), "w").limit(5000).collect()]
    assert len(words) == 5000
    took = {}
    for name, run in (("once", lambda: keywords.scored(docs, F.col("text"), words, ["doc_id"]).agg(F.sum("score")).first()), ("each", lambda: _each(docs, words[::10]).agg(F.sum("hits")).first())):
        began = time.time()
        run()
        took[name] = time.time() - began
    assert took["once"] < took["each"] * 10 / 4, took


def _each(docs, words):
    terms = F.array(*map(F.lit, words))
    return docs.select(F.size(F.filter(F.transform(terms, lambda k: text.occurrences(F.lower("text"), k)), lambda n: n > 0)).alias("hits"))


def test_topics_as_the_native_ones(spark):
    topics = {"x": [["The", "die"], ["ing", "heit"]], "none": [], "empty": [["the"], []], "two": [["a  b"]], "blank": [["the"], [" "]]}
    rows = spark.createDataFrame([(1, "the king"), (2, "die A\n B"), (3, None), (4, "THE")], "id int, t string")
    got = {r.id: r.topics for r in keywords.on_topics(rows, F.col("t"), topics, ["id"]).collect()}
    native = {r.id: sorted(k for k in topics if r[k]) for r in rows.select("id", *[text.matches_topic(F.col("t"), g).alias(k) for k, g in topics.items()]).collect()}
    assert got == native


RFC = "g:h g ./g g/ /g //g ?y g?y #s g#s g?y#s ;x g;x g;x?y#s . ./ .. ../ ../g ../.. ../../ ../../g ../../../g ../../../../g /./g /../g g. .g g.. ..g ./../g ./g/. g/./h g/../h g;x=1/./y g;x=1/../y g?y/./x g?y/../x g#s/./x g#s/../x".split()


def test_links_resolve_as_in_the_standard_library(spark):
    r = random.Random(1)
    rows = [(i, x, "http://a/b/c/d;p?q") for i, x in enumerate([*RFC, ""])]
    bases = ["https://h.test", "https://h.test/", "https://h.test/a/b", "https://h.test/a/b/", "https://H.test/a//b/c?q=1#f", "http://h.test/a/./b/../c", "https://h.test?x=/y"]
    for i in range(1500):
        middle = "/".join(r.choice(["a", "b", ".", "..", "", "c?x=1", "d;e", "é", "x.html", "..."]) for _ in range(r.randint(0, 5)))
        rows.append((100 + i, r.choice(["", "/", "//", "///", "//o.test/", "?", "#", "https://o.test/", "HTTPS://o.test"]) + middle + r.choice(["", "?", "#f", "?q=/../x"]), r.choice(bases)))
    frame = spark.createDataFrame(rows, "id long, link string, base string")
    both = frame.withColumn("own", urls.resolve(F.col("link"), F.col("base"))).join(html_trees.resolve_links(frame), "id")
    assert [tuple(x) for x in both.filter("NOT (own <=> resolved)").collect()] == []


def test_a_stream_that_stops_counts_on(spark, tmp_path):
    r = random.Random(5)
    rows = [(r.choice(["s", "s", "t", None]), i, f"u{i}", r.random() < 0.3) for i in range(300)]
    journal = spark.createDataFrame([("u4", "saved"), ("u4", "error"), ("u9", "error"), ("u40", "saved"), ("u41", "skipped_year")], "url string, status string")
    noted = {"u4": True, "u9": False, "u40": True, "u41": False}
    want, full = [], {}
    for site, pos, url, saves in rows:
        n = full.get(site, 0)
        if n < 5:
            want.append((site, pos, "journal" if url in noted else "saved" if saves else "visited", n))
            full[site] = n + (noted[url] if url in noted else saves)
    for name, parts in (("once", 1), ("thrice", 3)):
        for k in range(parts):
            some = rows[k * 300 // parts : (k + 1) * 300 // parts]
            spark.createDataFrame(some, quota.ARTICLES).coalesce(1).write.mode("append").parquet(str(tmp_path / name / "in"))
            quota.run(spark, str(tmp_path / name / "in"), str(tmp_path / name / "out"), str(tmp_path / name / "checkpoint"), journal, 5)
        found = spark.read.parquet(str(tmp_path / name / "out")).collect()
        assert sorted(((x.site, x.pos, x.status, x.saved_before) for x in found), key=lambda x: x[1]) == want
    native = setops.visited_under_quota(spark.createDataFrame(rows, quota.ARTICLES), "site", "pos", "saves", 5)
    assert native.count() > 0 and native.filter("saved_before >= 5").count() == 0
