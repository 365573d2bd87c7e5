"""Readers, writers and incremental runs on temporary folders."""

import json

from pyspark.sql import functions as F

from gleanmill.operators import setops
from gleanmill.sources import readers, sinks
from gleanmill.streaming import state


def write(path, content):
    path.write_text(content, encoding="utf-8")
    return str(path)


def test_lines_keywords_sources(spark, tmp_path):
    f = write(tmp_path / "a.txt", "# comment\n\n  B \na\nB\n")
    assert readers.keywords(spark, f) == ["b", "a", "b"]
    assert [r.value for r in readers.lines(spark, f, comments=False).orderBy("pos").collect()] == ["# comment", "B", "a", "B"]
    g = write(tmp_path / "s.txt", "WWW.x.test/\nhttps://x.test\nhttp://y.test/n/?q#f\n")
    assert sorted(r.source for r in readers.sources(spark, g).collect()) == ["http://y.test/n", "https://x.test"]


def test_missing_state_is_empty(spark, tmp_path):
    assert readers.state(spark, str(tmp_path / "none"), readers.PAGES_STATE).count() == 0
    assert readers.seen_urls(spark, str(tmp_path / "none")).count() == 0


def test_sites(spark):
    found = readers.sites(spark, "defaults: {date_regex: r, date_format: f}\nsites:\n- {start_urls: [u1, u2]}\n- {name: empty}\n- {name: n, start_urls: [v], date_regex: own}\n").orderBy("name").collect()
    assert [(r.name, r.date_regex, r.date_format) for r in found] == [("n", "own", "f"), ("u1", "r", "f")]


def test_journal(spark, tmp_path):
    f = write(tmp_path / "j.json", json.dumps({"u": {"status": "saved", "file": "f"}, "__listing__v": {"articles": ["a"], "pagination": []}}))
    articles, listings = readers.journal(spark, f)
    assert [(r.url, r.status, r.year) for r in articles.collect()] == [("u", "saved", None)]
    assert [(r.url, r.articles) for r in listings.collect()] == [("v", ["a"])]


def test_practitioners_and_delimited(spark, tmp_path):
    f = write(tmp_path / "p.txt", "Lyon;Dupont\nNice;Durand;x\n")
    people = readers.practitioners(spark, f)
    assert {(r.place, r.name) for r in people.collect()} == {("Lyon", "Dupont"), ("Nice", "Durand")}
    sinks.write_delimited(people, str(tmp_path / "out"))
    assert spark.read.text(str(tmp_path / "out")).count() == 2


def test_blobs_and_migration(spark, tmp_path):
    write(tmp_path / "u1.html", "x")
    assert [(r.uuid, r.type, bytes(r.content)) for r in readers.blobs(spark, str(tmp_path)).collect()] == [("u1", "html", b"x")]
    wider = sinks.with_columns_of(spark.range(1), {"id": "long", "score": "double"})
    assert wider.columns == ["id", "score"] and wider.first().score is None
    assert len(sinks.blob_ids(spark.sql("SELECT 'u' AS url")).first().uuid) == 64


def test_outcomes_seen_and_markdown(spark, tmp_path):
    rows = spark.sql("SELECT * FROM (VALUES (1, 'a', 'SUCCESS', 'k1', 'k2'), (2, 'b', 'OPEN_ERROR', 'k3', 'k4')) AS t(pos, outcome, status, url_key, final_key)")
    sinks.write_outcomes(rows, str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).count() == 2
    new = sinks.append_seen(rows, spark.sql("SELECT 'k2' AS url_key"), str(tmp_path / "seen"))
    assert [r.url_key for r in new.collect()] == ["k1"] and readers.seen_urls(spark, str(tmp_path / "seen")).count() == 1
    articles = spark.sql("SELECT * FROM (VALUES (1, 'T', '', '', 'u', '', 'x'), (2, '', '', '', 'v', '', '')) AS t(pos, title, date, authors, url, description, text)")
    sinks.write_markdown(articles, str(tmp_path / "md"))
    sinks.write_log(spark.sql("SELECT 'q' AS query, 'u' AS url"), str(tmp_path / "log"))
    whole = "\n".join(r.value for r in spark.read.text(str(tmp_path / "md")).collect())
    assert "# T" in whole and "# Sans titre" in whole and whole.count("---") == 1


def test_numbers_without_global_sort(spark):
    rows = spark.range(0, 300000, 7).select(F.col("id").alias("pos"))
    got = setops.numbered(rows, "pos").filter(F.col("n") != F.col("pos") / 7 + 1)
    assert got.count() == 0 and setops.numbered(rows.limit(0), "pos").count() == 0


def test_incremental_runs_keep_each_url_once(spark, tmp_path):
    source, out, checkpoint = (str(tmp_path / n) for n in ("in", "out", "ck"))
    first = spark.sql("SELECT * FROM (VALUES (1L, 'https://a.test/x'), (2L, 'https://A.test/x/'), (3L, 'https://a.test/y')) AS t(pos, url)")
    first.write.parquet(source)
    state.run(spark, source, "pos long, url string", out, checkpoint)
    assert spark.read.parquet(f"{out}/rows").count() == 2
    spark.sql("SELECT * FROM (VALUES (4L, 'https://a.test/y#f'), (5L, 'https://a.test/z')) AS t(pos, url)").write.mode("append").parquet(source)
    state.run(spark, source, "pos long, url string", out, checkpoint)
    assert sorted(r.url_key for r in spark.read.parquet(f"{out}/rows").collect()) == ["https://a.test/x", "https://a.test/y", "https://a.test/z"]
    state.run(spark, source, "pos long, url string", out, checkpoint)
    assert spark.read.parquet(f"{out}/state").count() == 3
