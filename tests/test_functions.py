"""Properties and edge cases of the expressions."""

import pytest
from pyspark.sql import functions as F

from gleanmill.functions import classify, dates, text, urls
from tests import golden_tables as X
from gleanmill.plans import pipelines


def test_normal_forms_are_idempotent(spark):
    rows = spark.sql(X.RESULTS).filter("url <> ''")
    for form in (urls.basic, urls.seen_key, urls.canonical):
        once = rows.select(form(F.col("url")).alias("u"))
        assert once.filter(F.col("u") != form(F.col("u"))).count() == 0


def test_nulls_and_empty_texts(spark):
    rows = spark.sql("SELECT CAST(NULL AS STRING) AS t UNION ALL SELECT ''")
    out = rows.select(
        text.keyword_score(F.col("t"), ["a"]).alias("score"), text.word_count(F.col("t")).alias("words"), text.blank_count(F.col("t")).alias("blank"),
        text.scorer_text(F.col("t")).alias("plain"), classify.is_block(F.col("t")).alias("block"), urls.canonical(F.col("t")).alias("canon"),
        urls.source_form(F.col("t")).alias("source"), text.matches_topic(F.col("t"), [["a"]]).alias("topic"), dates.recent(dates.largest_year(F.col("t"))).alias("recent"),
    )
    for r in out.collect():
        assert (r.score, r.words, r.blank, r.plain, r.block, r.canon, r.source, r.topic, r.recent) == (0.0, 0, 0, "", False, "", "", False, False)


def test_score_without_keywords_and_overlaps(spark):
    row = spark.range(1).select(text.keyword_score(F.lit("x"), []).alias("none"), text.occurrences(F.lit("aaaa"), F.lit("aa")).alias("n"), text.keyword_score(F.lit("aaaa b"), ["aa", "b", "zz"]).alias("s")).first()
    assert row.none == 0.0 and row.n == 2
    assert row.s == pytest.approx(round((1 + 0.6931471805599453 + 1) / 3, 4))


def test_every_row_has_one_outcome(spark):
    rows = pipelines.topic_funnel(spark.sql(X.FETCHES))
    assert rows.filter("outcome IS NULL").count() == 0
    assert rows.count() == 15


def test_name_limits(spark):
    long = "https://h.test/" + "a" * 400
    row = spark.range(1).select(urls.slug_name(F.lit(long)).alias("slug"), urls.topic_name(F.lit("https://h.test/?"), F.lit("html")).alias("root")).first()
    assert len(row.slug) == 185 and row.root == "h.test_root.html"


def test_filters_reach_the_scan(spark):
    plan = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").filter("lang = 'en'").select("doc_id", text.word_count(F.col("text")).alias("n"))
    shown = plan._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(lang,en)" in shown and "n_chars" not in shown and "Python" not in shown


def test_references_as_the_standard_library_reads_them(spark):
    import html

    from gleanmill.functions import text

    cases = ["caf&eacute; &rsquo;x&rsquo; &#233;&#xE9;&#X27; &hellip;", "&amp;eacute; &unknown; &; & &&amp;&lt;b&gt;", "&#0;&#128;&#55296;&#1114112;&#9999999;&#128512;", "a&b;c &copy &reg;", "", "&apos;&quot;&nbsp;|"]
    rows = spark.createDataFrame([(c,) for c in cases], "t string").select("t", text.unescape("t").alias("u")).collect()
    for r in rows:
        want = html.unescape(r.t.replace("&copy ", "&amp;copy ").replace("&unknown;", "&amp;unknown;"))
        assert r.u == want, r


def test_a_cluster_without_a_shared_folder_is_an_error(monkeypatch):
    import pytest

    from gleanmill import session

    class Context:
        master = "local-cluster[3,2,3000]"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default):
                return default

    with pytest.raises(ValueError):
        session.ensure_checkpoint_dir(Session())


def test_numbers_of_sparse_and_equal_positions(spark):
    from gleanmill.operators import setops

    rows = spark.range(500).selectExpr("xxhash64(id) AS pos").union(spark.sql("SELECT 7L AS pos")).union(spark.sql("SELECT 7L AS pos")).repartition(5)
    got = setops.numbered(rows, "pos").collect()
    assert sorted(r.n for r in got) == list(range(1, 503))
    assert [r.pos for r in sorted(got, key=lambda r: r.n)] == sorted(r.pos for r in got)
    assert setops.numbered(rows.limit(0), "pos").count() == 0


def test_a_judge_that_fails_keeps_nothing(spark):
    from gleanmill.operators import html_trees

    def broken(prompts):
        raise OSError("no judge")

    rows = spark.sql("SELECT * FROM (VALUES (1L, 'x'), (2L, NULL)) AS t(id, text)")
    assert {r.interesting for r in html_trees.interest(rows, broken).collect()} == {False}
    assert {r.interesting for r in html_trees.interest(rows, lambda p: ['{"interessant": true}'] * len(p)).collect()} == {True}
    assert {r.interesting for r in html_trees.interest(rows).collect()} == {False}


def test_selectors():
    from gleanmill.operators.html_trees import dom, select

    page = dom('<div id="a" class="x y"><p><span data-k="v1">one</span><p class="z">two</div><ul><li>3<li class="z">4</ul>')
    found = lambda s: [e.text() for e in select(page, s)]
    assert found("div.x > p span[data-k]") == ["one"] and found("p.z, li.z") == ["two", "4"] and found("#a p") == ["one", "two"]
    assert found('[data-k^="v"]') == ["one"] and found("ul > li") == ["3", "4"] and found("div > li") == [] and found("*.z") == ["two", "4"]
