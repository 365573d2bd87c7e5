"""Rows that larger tables have and the small ones don't, each query against its SQL."""

import duckdb

from gleanmill.functions import text
from gleanmill.operators import html_trees
from gleanmill.plans import catalog
from tests.conftest import same_rows


def check(spark, folder, name, **tables):
    """A query and its SQL give the same rows over these tables."""
    db = duckdb.connect()
    for table, (schema, rows) in tables.items():
        spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{table}.parquet")
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    same_rows(catalog.QUERIES[name](spark, str(folder)), db.sql(catalog.ORACLES[name]))


PAGES = "page_id long, url string, html string"
CUT = "A &amp;&amp;&amp &eacute;&eacute &#65;&#65 &#1;&#150;&#0; &ngE;&AMP; &amp;lt; &x"


def test_references_without_a_semicolon_stay(spark, tmp_path):
    page = f"<title>{CUT}</title><article><p>{CUT}</p><p>b &lt</p></article>"
    check(spark, tmp_path, "article_parts", pages=(PAGES, [(1, "http://h.test/", page)]))
    assert html_trees.article_of(page, "")["title"] == text.unescaped(CUT)


def test_an_id_in_a_title_is_no_year(spark, tmp_path):
    rows = [(i, f"https://h.test/{i}", "") for i in (7, 2016, 2026, 2099, 12000)]
    check(spark, tmp_path, "search_page_results", pages=(PAGES, rows))


def test_titles_have_years_unless_told_otherwise():
    page = '<div class="result"><a href="https://h.test/">In 2024</a><span>2020</span></div>'
    assert [html_trees.search_results_of(page, t)[0]["year"] for t in (True, False)] == [2024, 2020]


def test_words_with_line_breaks_are_in_no_squeezed_text(spark, tmp_path):
    items = [(1, "one two"), (2, "one\nTwo three"), (3, "\nthree"), (4, "three \n"), (5, " one  three")]
    docs = [(1, "One\ntwo  three"), (2, "two three"), (3, None)]
    check(spark, tmp_path, "topics_many", benchmark=("item_id long, text string", items), documents=("doc_id long, text string", docs))


def test_every_page_has_all_three_addresses_with_escapes(spark, tmp_path):
    check(spark, tmp_path, "url_canonical_escapes", pages=(PAGES, [(4, "http://h.test/", ""), (9, "http://h.test/", "")]))
    told = sorted(r.u for r in catalog.QUERIES["url_canonical_escapes"](spark, str(tmp_path)).filter("page_id = 4").collect())
    assert told == ["https://h4.test/?a+b=c+d%26e&n=4&z=%C3%A9~%2A", "https://h4.test/?k=%25zz", "https://h4.test/x?a=1&a=2&b"]
