"""Golden rows: small fixed tables with what must come out, for cases that hardly occur in whole tables.

The catalogue has queries of the same names over rows of the given tables.
"""

import pytest
from pyspark.sql import functions as F

from gleanmill.functions import classify, dates, text, urls
from gleanmill.functions import constants as C
from gleanmill.operators import html_trees, setops, walks
from gleanmill.plans import duck as D
from gleanmill.plans import pipelines
from gleanmill.plans.catalog import _chain_sql, _news_sql, _obstacle_sql, _obstacles, _topic_year_sql
from gleanmill.plans.derived import _SUFFIX_CASES
from gleanmill.sources import readers
from tests import golden_tables as X
from tests.conftest import DATA, same_rows

QUERIES, ORACLES = {}, {}


def query(sql):
    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


@query("""SELECT * FROM (VALUES (1, true, false, true), (2, false, false, true), (3, false, false, true), (4, true, false, true), (5, false, false, true), (6, false, false, true)) AS t(id, cnf, empty_group, no_groups)""")
def cnf_match(spark, d):
    t, groups = F.col("txt"), [["iran"], ["USA", "Israel"], ["crisis"]]
    return X.fixture(spark, X.TOPICS).select("id", text.matches_topic(t, groups).alias("cnf"), text.matches_topic(t, [["iran"], []]).alias("empty_group"), text.matches_topic(t, []).alias("no_groups"))


@query("""SELECT 'iran AND (USA OR Israel) AND "deep sea"' AS q, 'site:a.test iran AND (USA OR Israel) AND "deep sea"' AS site_q, 'https://duckduckgo.com/html/?q=deep+sea%26x' AS search""")
def cnf_query_text(spark, d):
    groups = F.array(F.array(F.lit("iran")), F.array(F.lit("USA"), F.lit("Israel"), F.lit(" ")), F.array(F.lit("")), F.array(F.lit("deep sea")))
    return spark.range(1).select(urls.boolean_query(groups).alias("q"), urls.site_query(F.lit("a.test"), groups).alias("site_q"), urls.search_url(F.lit("deep sea&x")).alias("search"))


@query(f"SELECT pos, {D.seen_key('url')} AS seen, {D.canonical('url')} AS canon FROM ({X.RESULTS}) WHERE url IS NOT NULL")
def url_forms_golden(spark, d):
    return X.fixture(spark, X.RESULTS).filter("url IS NOT NULL").select("pos", urls.seen_key(F.col("url")).alias("seen"), urls.canonical(F.col("url")).alias("canon"))


@query("""SELECT * FROM (VALUES (1, 'https://h.test/x'), (2, 'https://h.test/a/c'), (3, 'https://h.test/a/c?x=1'), (4, 'https://h.test/a/b?p=2'), (5, 'https://h.test/a/b?q=1'), (6, 'https://o.test/z'),
 (7, NULL), (8, NULL), (9, NULL), (10, 'https://h.test/n'), (11, 'https://o.test/k'), (12, NULL), (13, 'https://h.test/a/b')) AS t(id, u)""")
def url_resolve(spark, d):
    return X.fixture(spark, X.LINKS).select("id", urls.resolve(F.col("link"), F.col("base")).alias("u"))


@query("""SELECT * FROM (VALUES (1, 'https://h.test/x'), (2, 'https://h.test/a/c'), (3, 'https://h.test/a/c?x=1'), (4, 'https://h.test/a/b?p=2'), (5, 'https://h.test/a/b?q=1'), (6, 'https://o.test/z'),
 (7, NULL), (8, NULL), (9, NULL), (10, 'https://h.test/n'), (11, 'https://o.test/k'), (12, NULL), (13, 'https://h.test/a/b')) AS t(id, resolved)""")
def url_resolve_full(spark, d):
    return html_trees.resolve_links(X.fixture(spark, X.LINKS))


@query(f"""SELECT s AS source, CASE WHEN trim(s) = '' THEN '' ELSE {D.scheme('l')} || '://' || {D.domain('l')} || rtrim({D.path('l')}, '/') END AS form
FROM (SELECT s, CASE WHEN starts_with(trim(s), 'http') THEN trim(s) ELSE 'https://' || trim(s) END AS l FROM (VALUES ('exemple.com'), (' https://WWW.Example.com/ '), ('http://www.x.test/news/?a=1#b'), ('')) AS t(s))""")
def url_source_form(spark, d):
    rows = spark.sql("SELECT * FROM (VALUES ('exemple.com'), (' https://WWW.Example.com/ '), ('http://www.x.test/news/?a=1#b'), ('')) AS t(s)")
    return rows.select(F.col("s").alias("source"), urls.source_form(F.col("s")).alias("form"))


@query("""SELECT * FROM (VALUES (3, 'https://site.test/news/', 'https://site.test/news/', true), (14, 'https://duckduckgo.com/about', 'https://duckduckgo.com/about', false),
 (16, 'https://other.test/l/?uddg=https%3A%2F%2Fd.test%2F', 'https://d.test/', false)) AS t(pos, strict, loose, redirect)""")
def redirect_unwrap(spark, d):
    rows = X.fixture(spark, X.RESULTS).filter("pos IN (3, 14, 16)")
    return rows.select("pos", urls.unwrap_redirect(F.col("url")).alias("strict"), urls.unwrap_any_redirect(F.col("url")).alias("loose"), urls.is_redirect(F.col("url")).alias("redirect"))


@query("""SELECT * FROM (VALUES (1, 'site.test_a_b_c.html_x_1_y_2.html', 'site.test_a_b_c.html_x_1_y_2.html', 'page_1.html'), (2, 'site.test.html', 'site.test_root.pdf', 'page_2.pdf'),
 (9, 'site.test_été_ü.html', 'site.test_t.html', 'page_9.html'), (10, 'site.test_--a--_b.html', 'site.test_--a--_b.html', 'page_10.html')) AS t(id, slug, topic, indexed)""")
def slug_filename(spark, d):
    rows = X.fixture(spark, X.NAMES).filter("id IN (1, 2, 9, 10)")
    return rows.select("id", urls.slug_name(F.col("url")).alias("slug"), urls.topic_name(F.col("url"), F.col("kind")).alias("topic"), urls.indexed_name(F.col("id"), F.col("kind")).alias("indexed"))


@query(f"SELECT id, {D.pagination('url')} AS pagination, {D.article_candidate('url')} AS candidate, ({D.suffix('url')} = '' OR list_contains({D.lits(C.ALLOWED_SUFFIXES)}, {D.suffix('url')})) AS suffix_ok, regexp_matches(url, '(?i)/f') AND {D.article_candidate('url')} AS by_pattern FROM ({X.NAMES})")
def url_predicates_golden(spark, d):
    return X.fixture(spark, X.NAMES).select("id", urls.pagination_url(F.col("url")).alias("pagination"), urls.article_candidate(F.col("url")).alias("candidate"), urls.suffix_allowed(F.col("url")).alias("suffix_ok"), urls.article_url(F.col("url"), F.lit("/f")).alias("by_pattern"))


@query(f"SELECT a.url, CASE WHEN starts_with(a.url, 'https://h.test/private/open') THEN true WHEN starts_with(a.url, 'https://h.test/private') THEN false ELSE true END AS allowed FROM ({X.ASKED}) a")
def robots_rules(spark, d):
    rules = X.fixture(spark, X.ROBOTS).groupBy("host").agg(F.collect_list(F.struct("prefix", "allow")).alias("rules"))
    asked = X.fixture(spark, X.ASKED).withColumn("host", urls.host(F.col("url")))
    return asked.join(rules, "host", "left").select("url", urls.robots_allowed(F.coalesce("rules", F.array().cast("array<struct<prefix:string,allow:boolean>>")), F.col("url")).alias("allowed"))


@query(f"""SELECT id, CASE lower(trim(split_part(coalesce(content_type, ''), ';', 1))) {_SUFFIX_CASES} ELSE CASE WHEN {D.suffix('url')} <> '' AND length({D.suffix('url')}) <= 8 THEN {D.suffix('url')} ELSE '.bin' END END AS suffix,
 CASE WHEN lower({D.path('url')}) LIKE '%.pdf' OR coalesce(content_type, '') LIKE '%pdf%' THEN 'pdf' WHEN lower({D.path('url')}) LIKE '%.docx' OR coalesce(content_type, '') LIKE '%docx%' THEN 'docx' WHEN lower({D.path('url')}) LIKE '%.doc' THEN 'doc'
 WHEN lower({D.path('url')}) LIKE '%.txt' OR coalesce(content_type, '') LIKE '%text/plain%' THEN 'txt' ELSE 'html' END AS kind FROM ({X.NAMES})""")
def mime_ext(spark, d):
    return X.fixture(spark, X.NAMES).select("id", classify.guess_suffix(F.col("content_type"), F.col("url")).alias("suffix"), classify.file_kind(F.col("url"), F.col("content_type")).alias("kind"))


@query("SELECT * FROM (VALUES (1, 'pdf', '%pdf-1.7'), (2, 'html', ' <html><body>é</body>'), (3, 'other', 'abc'), (4, 'html', 'caf\u00e9'), (5, 'pdf', '')) AS t(id, kind, decoded)")
def file_type(spark, d):
    rows = spark.sql("""SELECT * FROM (VALUES (1, 'https://a.test/x', '', CAST('%PDF-1.7' AS BINARY)), (2, 'https://a.test/x', NULL, CAST(' <HTML><body>é</body>' AS BINARY)), (3, 'https://a.test/x', 'x/y', CAST('abc' AS BINARY)),
      (4, 'https://a.test/x', 'text/html; charset=latin-1', X'636166E9'), (5, 'https://a.test/x.pdf', 'text/html', CAST('' AS BINARY))) AS t(id, url, content_type, content)""")
    return rows.select("id", classify.content_kind(F.col("url"), F.col("content_type"), F.col("content")).alias("kind"), text.bytes_text(F.col("content")).alias("decoded"))


@query("SELECT * FROM (VALUES (1, true), (2, false), (3, true), (4, NULL), (5, NULL), (6, false), (7, true), (8, false), (9, false), (10, NULL), (11, NULL), (12, NULL)) AS t(id, flag)")
def json_bool(spark, d):
    return X.fixture(spark, X.ANSWERS).select("id", classify.answer_flag(F.col("answer")).alias("flag"))


@query("SELECT 'DATE : ' || chr(10) || 'REQUETE : q' || chr(10) || 'RANG : 3' || chr(10) || 'MOTEUR : ' || chr(10) || 'URL : u' || chr(10) || 'URL FINALE : ' || chr(10) || 'STATUT : SUCCESS' || chr(10) || 'TYPE : ' || chr(10) || 'FICHIER : ' || chr(10) || 'MESSAGE : ' || chr(10) || repeat('-', 60) || chr(10) AS block, 'a b c' AS one")
def log_render(spark, d):
    entry = {"query": F.lit("q"), "rank": F.lit(3), "url": F.lit("u"), "status": F.lit("SUCCESS")}
    return spark.range(1).select(text.log_block(entry).alias("block"), text.one_line(F.lit(" a \n b\n c ")).alias("one"))


ARTICLE_PAGES = """SELECT * FROM (VALUES
  (1, 'u', '<title>T &amp; t</title><meta name="author" content="A"><meta property="og:description" content="D"><nav><p>menu</p></nav><article><h1>H</h1><p>One <b>bo</b>ld<p>Two<aside><p>side</p></aside><div class="comments"><p>I</p></div><form><p>f</p></form></article><footer><p>foot</p></footer>'),
  (2, 'u', '<h1>Only h1</h1><header><p>head</p></header><div><p>body &eacute;</p></div><table><tr><td><p>cell</p></table>'), (3, 'u', ''), (4, 'u', NULL)
) AS t(page_id, url, html)"""


@query("""SELECT * FROM (VALUES (1, 'u', 'T & t', '', 'A', 'D', 'One bold' || chr(10) || 'Two'), (2, 'u', 'Only h1', '', '', '', 'body é'), (3, 'u', '', '', '', '', ''), (4, 'u', '', '', '', '', '')) AS t(page_id, url, title, date, authors, description, text)""")
def article_golden(spark, d):
    return html_trees.articles(X.fixture(spark, ARTICLE_PAGES))


EDITORIAL_PAGES = """SELECT * FROM (VALUES
  (1, 'https://h.test/', '<nav><a href="/menu/one">m</a></nav><article><a href="/story-one">1</a><a href="/about/us">2</a></article><h2><a href="story-two">3</a></h2><h3><a href="https://o.test/x-y">4</a></h3>'),
  (2, 'https://h.test/', '<div class="card post"><a href="/p/alpha">1</a></div><div class="other"><a href="/p/beta">2</a></div>'), (3, 'https://h.test/', '<p><a href="/p/gamma">x</a></p>')
) AS t(page_id, url, html)"""


@query("SELECT * FROM (VALUES (1, 'https://h.test/story-one https://h.test/story-two'), (2, 'https://h.test/p/alpha'), (3, '')) AS t(page_id, links)")
def editorial_golden(spark, d):
    return html_trees.editorial_links(X.fixture(spark, EDITORIAL_PAGES)).select("page_id", F.array_join("links", " ").alias("links"))


SEARCH_PAGES = """SELECT * FROM (VALUES
  (1, '<div class="result"><a class="result__url" href="https://w.test/0">w</a><a class="result__a" href="https://x.test/1?utm_source=q">One <b>big</b></a><a class="result__snippet">said in 2024 and 2025</a></div><div class="result"><a href="https://www.x.test/1/">again</a></div><div class="web-result"><a href="/l/?uddg=https%3A%2F%2Fy.test%2Fa%3Fb%3D1">Y &eacute;</a><span class="snippet">no year</span></div><div class="result">no link</div><p><a href="https://z.test">z</a></p>'),
  (2, ''), (3, '<div class="results_links"><span>2023</span><a class="result-link" href=" https://v.test/ ">V</a></div>')
) AS t(page_id, html)"""


@query("""SELECT * FROM (VALUES (1, 0, 'https://x.test/1?utm_source=q', 'One big', 'said in 2024 and 2025', 2025), (1, 2, 'https://y.test/a?b=1', 'Y é', 'no year', NULL), (3, 0, 'https://v.test/', 'V', '', 2023)) AS t(page_id, pos, url, title, snippet, search_year)""")
def search_page_results(spark, d):
    return html_trees.search_results(X.fixture(spark, SEARCH_PAGES))


@query("""SELECT * FROM (VALUES (1, 2024, 2024), (2, 2021, 2021), (3, 2026, 2026), (4, 2019, 2019)) AS t(page_id, year, again)""")
def selector_year(spark, d):
    """The element that the site's selector names comes first; without a selector the site's pattern does."""
    rows = spark.sql("""SELECT * FROM (VALUES (1, 'https://s.test/2020/x', '<div class="meta"><span class="when">Paru le 03/02/2024</span></div><meta name="date" content="2022">', 'div.meta > .when', NULL),
      (2, 'https://s.test/x', '<span class="when">hier</span><meta name="date" content="2021">', '.when', NULL), (3, 'https://s.test/2026/x', '<p>none</p>', '#missing', NULL), (4, 'https://s.test/2026/x', '<p>vol 2019-7</p>', NULL, '20[0-9]{2}-[0-9]'))
      AS t(page_id, url, html, date_selector, date_regex)""")
    told = rows.join(html_trees.selected(rows).withColumnRenamed("page_id", "p"), F.col("page_id") == F.col("p")).withColumn("t", text.topic_text(F.col("html")))
    by = lambda r, c: dates.article_year(F.col("html"), F.col("url"), F.col("t"), r, c)
    year = F.when(F.col("date_selector").isNotNull(), by(None, F.col("selected"))).otherwise(by("20[0-9]{2}-[0-9]", None))
    return told.select("page_id", year.alias("year"), year.alias("again"))


@query("SELECT * FROM (VALUES (1, 'café'), (2, 'café'), (3, 'caf\ufffd'), (4, 'x')) AS t(id, html)")
def decoded_pages(spark, d):
    rows = spark.sql("SELECT * FROM (VALUES (1, X'636166E9', 'text/html; charset=iso-8859-1'), (2, CAST('café' AS BINARY), NULL), (3, X'636166E9', ''), (4, CAST('x' AS BINARY), 'text/html; charset=unknown-9')) AS t(id, content, content_type)")
    return html_trees.decode_pages(rows)


@query(f"""SELECT pos, url_key, row_number() OVER (ORDER BY pos) AS rank FROM (SELECT pos, {D.seen_key('url')} AS url_key FROM ({X.RESULTS}) QUALIFY row_number() OVER (PARTITION BY url_key ORDER BY pos) = 1) WHERE url_key <> ''""")
def dedupe_keep_first(spark, d):
    return setops.dedupe_ranked(X.fixture(spark, X.RESULTS), "url", "pos").select("pos", "url_key", "rank")


@query(f"""WITH r AS (SELECT pos, {D.seen_key('url')} AS k FROM ({X.RESULTS})) SELECT pos, k AS url_key FROM r WHERE k <> '' AND NOT {D.is_redirect('k')} AND lower({D.host_raw('k')}) <> '{C.SEARCH_HOST}' AND k <> 'https://site.test/news'
 QUALIFY row_number() OVER (PARTITION BY k ORDER BY pos) = 1""")
def filter_results(spark, d):
    history = spark.sql("SELECT 'https://site.test/news' AS url_key")
    return setops.filter_results(X.fixture(spark, X.RESULTS), "url", "pos", history).select("pos", "url_key")


@query(f"SELECT url FROM ({X.FRONTIER}) WHERE url NOT IN (SELECT url FROM ({X.STATE}) UNION ALL SELECT url FROM ({X.FAILED}))")
def seen_antijoin(spark, d):
    return setops.unseen(X.fixture(spark, X.FRONTIER), "url", X.fixture(spark, X.STATE), X.fixture(spark, X.FAILED))


@query(f"SELECT url FROM ({X.FRONTIER}) WHERE url IN (SELECT url FROM ({X.STATE}))")
def seen_semijoin(spark, d):
    return setops.seen(X.fixture(spark, X.FRONTIER), "url", X.fixture(spark, X.STATE))


@query(f"SELECT uuid, url, domaine, crawled FROM ({X.STATE}) WHERE score IS NULL")
def unscored_scan(spark, d):
    state = X.fixture(spark, X.STATE).select("uuid", "url", "domaine", "score", F.lit("html").alias("type"), F.lit(1).alias("profondeur"), F.timestamp_seconds("crawled").alias("date_crawl"))
    return readers.to_score(state).select("uuid", "url", "domaine", F.unix_timestamp("date_crawl").cast("int").alias("crawled"))


@query(f"SELECT uuid, uuid IN ('u1', 'u3') AS has_blob FROM ({X.STATE})")
def blob_split(spark, d):
    rows = X.fixture(spark, X.STATE)
    there, missing = setops.split_by_blob(rows, spark.sql("SELECT * FROM (VALUES ('u1'), ('u3'), ('u9')) AS t(uuid)"), "uuid")
    return there.select("uuid", F.lit(True).alias("has_blob")).unionByName(missing.select("uuid", F.lit(False).alias("has_blob")))


@query(f"SELECT pos FROM (SELECT pos, coalesce(sum(saved::INT) OVER (PARTITION BY site ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM ({X.VISITS})) WHERE b < 3")
def quota_running(spark, d):
    return setops.visited_under_quota(X.fixture(spark, X.VISITS), "site", "pos", "saved").select("pos")


@query(f"SELECT pos, CASE WHEN saved THEN 7 + row_number() OVER (PARTITION BY saved ORDER BY pos) - 1 END AS file_index FROM ({X.VISITS})")
def success_numbers(spark, d):
    return setops.number_successes(X.fixture(spark, X.VISITS), "pos", "saved", 7).select("pos", "file_index")


@query("SELECT 13 AS next_index")
def next_file_index(spark, d):
    names = spark.sql("SELECT * FROM (VALUES ('page_3.html'), ('page_12.pdf'), ('other_99.html'), ('page_x.html')) AS t(name)")
    return setops.next_index(names, "name")


@query("""SELECT p.place, p.name, coalesce(d.tel, 'phone vide') AS tel, coalesce(d.mail, 'mail vide') AS mail FROM (VALUES ('Lyon', 'Dupont'), ('Paris', 'Martin'), ('Nice', 'Durand')) AS p(place, name)
 LEFT JOIN (VALUES ('Lyon', 'Dupont', '01 02', 'a@x.test'), ('Paris', 'Martin', NULL, NULL)) AS d(place, name, tel, mail) USING (place, name)""")
def lookup_enrich(spark, d):
    return setops.lookup(X.fixture(spark, X.PEOPLE), X.fixture(spark, X.DIRECTORY), ["place", "name"], "pos")


@query(f"SELECT query, pos FROM (SELECT *, min(prio) OVER (PARTITION BY query) AS best FROM ({X.RESULTS})) WHERE prio = best")
def engine_fallback(spark, d):
    return setops.first_source(X.fixture(spark, X.RESULTS), "query", "prio").select("query", "pos")


@query(f"SELECT url FROM ({X.STATE}) UNION SELECT url FROM ({X.FRONTIER})")
def upsert_ignore(spark, d):
    new = X.fixture(spark, X.FRONTIER).withColumn("pos", F.monotonically_increasing_id())
    twice = new.unionByName(new.withColumn("pos", F.col("pos") + 100))
    return setops.insert_new(X.fixture(spark, X.STATE).select("url"), twice, "url", "pos")


@query("""SELECT * FROM (VALUES ('s', 'a', 'a', 1), ('s', 'a', 'b', 2), ('s', 'x', 'x', 1), ('s', 'x', 'b', 2), ('t', 'y', 'y', 1)) AS t(site, start, url, nth)""")
def listing_walk(spark, d):
    """Two starts of one site visit two pages each, whatever the other visits."""
    starts = spark.sql("SELECT * FROM (VALUES ('s', 'a'), ('s', 'x'), ('t', 'y')) AS t(site, url)")
    links = spark.sql("SELECT * FROM (VALUES ('a', 'c', 2), ('a', 'b', 1), ('b', 'd', 1), ('x', 'b', 1), ('y', 'y', 1)) AS t(src, dst, pos)")
    return walks.listing_walk(starts, links)


@query("SELECT * FROM (VALUES ('Lyon', 'Dupont', 'found'), ('Paris', 'Martin', 'not_found'), ('Nice', 'Durand', 'not_found'), ('Metz', ' ', 'missing_name'), ('Metz', NULL, 'missing_name')) AS t(place, name, outcome)")
def lookup_outcomes(spark, d):
    people = X.fixture(spark, X.PEOPLE).unionByName(spark.sql("SELECT * FROM (VALUES ('Metz', ' '), ('Metz', NULL)) AS t(place, name)"))
    found = setops.lookup(people, X.fixture(spark, X.DIRECTORY), ["place", "name"], "pos")
    return found.select("place", "name", setops.lookup_outcome(F.col("name"), F.col("tel"), F.col("mail")).alias("outcome"))


ROUTES = """SELECT * FROM (VALUES
  (1, 'https://www.site.test/news/long-title'), (2, 'https://site.test/page/3/'), (3, 'https://other.test/x'), (4, 'https://site.test/tag/x'), (5, 'https://SITE.test/a?page=2'), (6, 'https://sub.site.test/a'), (7, 'https://site.test/f.pdf')
) AS t(id, url)"""


@query("""SELECT * FROM (VALUES (1, 'article', true, false), (2, 'pagination', true, true), (3, 'off_domain', false, false), (4, 'none', true, true), (5, 'pagination', true, false), (6, 'off_domain', false, false), (7, 'none', true, true)) AS t(id, route, same_domain, same_host)""")
def url_routes(spark, d):
    u, site = F.col("url"), F.lit("site.test")
    return X.fixture(spark, ROUTES).select("id", urls.route(u, F.lit("www.site.test")).alias("route"), urls.same_domain(u, site).alias("same_domain"), urls.same_host(u, site).alias("same_host"))


@query("""SELECT * FROM (VALUES (1, 'https://h.test/?a+b=c+d%26e&z=%C3%A9~%2A'), (2, 'https://h.test/?k=%25zz'), (3, 'https://h.test/x?a=1&a=2&b')) AS t(id, u)""")
def url_canonical_escapes(spark, d):
    rows = spark.sql("SELECT * FROM (VALUES (1, 'https://www.h.test?z=é%7E*&a%20b=c+d%26e&utm_source=x'), (2, 'https://h.test/?k=%zz'), (3, 'https://h.test//x/?b=&a=2&a=1&gclid=')) AS t(id, url)")
    return rows.select("id", urls.canonical(F.col("url")).alias("u"))


@query("""SELECT * FROM (VALUES (1, '<html><head><base href="u"/><title>x</title>'), (2, '<HEAD><BASE href="/y">'), (3, '<base href="u"/><p>no head'), (4, '<head class="a"><base href="u"/></head>')) AS t(id, html)""")
def base_golden(spark, d):
    rows = spark.sql("""SELECT * FROM (VALUES (1, '<html><head><title>x</title>'), (2, '<HEAD><BASE href="/y">'), (3, '<p>no head'), (4, '<head class="a"></head>')) AS t(id, html)""")
    return rows.select("id", text.with_base(F.col("html"), F.lit("u")).alias("html"))


@query("""SELECT * FROM (VALUES (1, '# T & t' || chr(10) || chr(10) || '**Auteur(s) :** A' || chr(10) || '**Source :** u' || chr(10) || chr(10) || '## Résumé' || chr(10) || chr(10) || 'D' || chr(10) || chr(10) || '## Contenu' || chr(10) || chr(10) || 'One bold' || chr(10) || 'Two'),
 (2, '# Only h1' || chr(10) || chr(10) || '**Source :** u' || chr(10) || chr(10) || '## Contenu' || chr(10) || chr(10) || 'body é'), (3, '# Sans titre' || chr(10) || chr(10) || '**Source :** u' || chr(10)), (4, '# Sans titre' || chr(10) || chr(10) || '**Source :** u' || chr(10))) AS t(page_id, md)""")
def markdown_articles(spark, d):
    """Articles with authors, description and text; what is missing is left out."""
    return html_trees.articles(X.fixture(spark, ARTICLE_PAGES)).select("page_id", text.markdown(*[F.col(c) for c in ("title", "date", "authors", "url", "description", "text")]).alias("md"))


@query("""SELECT 15 AS total, 1 AS excluded, 1 AS duplicate, 3 AS download_error, 1 AS other_skipped, 1 AS pdf_saved, 1 AS rejected_topic, 1 AS rejected_short, 1 AS rejected_no_date, 1 AS rejected_old, 1 AS rejected_judge, 3 AS html_saved""")
def funnel_outcomes(spark, d):
    return setops.outcome_counts(pipelines.topic_funnel(X.fixture(spark, X.FETCHES)), "outcome", pipelines.FUNNEL)


@query("""SELECT 2 AS sources_loaded, 10 AS site_results_found, 5 AS global_results_found, 15 AS found_total, 1 AS duplicates_removed, 1 AS excluded_urls_removed, 13 AS urls_unique, 1 AS pdf_saved, 3 AS html_saved,
 1 AS rejected_topic, 1 AS rejected_short, 1 AS rejected_no_date, 1 AS rejected_old, 1 AS rejected_judge, 1 AS other_skipped, 3 AS download_error""")
def run_counters(spark, d):
    found = pipelines.topic_funnel(X.fixture(spark, X.FETCHES)).withColumn("source_type", F.when(F.col("pos") <= 10, F.lit("site")).otherwise(F.lit("global")))
    return pipelines.run_counters(spark.sql("SELECT * FROM (VALUES ('a.test'), ('b.test')) AS t(source)"), found)


@query("SELECT * FROM (VALUES ('error', 5), ('not_article', 2), ('saved', 2), ('skipped_year', 2)) AS t(outcome, n)")
def visit_report(spark, d):
    rows = spark.sql("SELECT * FROM (VALUES (403, 9, 2026), (404, 9, 2026), (410, 9, 2026), (429, 9, 2026), (503, 9, 2026), (500, 9, 2026), (NULL, 3, 2026), (200, 2, 2026), (200, 0, NULL), (200, 5, NULL), (200, 5, 2025)) AS t(code, news_score, year)")
    return pipelines.visit_outcome(rows, 2026).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT * FROM (VALUES ('SEARCH_ERROR', 1), ('UNKNOWN_ERROR', 2), ('SUCCESS', 1)) AS t(status, n)")
def failure_statuses(spark, d):
    rows = spark.sql("SELECT * FROM (VALUES ('search', 200), ('open', 200), ('other', NULL), (NULL, 200)) AS t(failure, code)")
    return pipelines.result_status(rows.select("failure", "code", F.lit(False).alias("known"), F.lit("https://a.test").alias("url"), F.lit("html").alias("kind"))).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT status, count(*) AS n FROM (SELECT CASE WHEN known THEN 'SKIPPED_ALREADY_SEEN' WHEN code IS NULL THEN 'OPEN_ERROR' WHEN contains(url, '{C.SEARCH_HOST}') THEN 'SEARCH_ENGINE_PAGE_SKIPPED' WHEN code >= 400 THEN 'DOWNLOAD_FAILED' ELSE 'SUCCESS' END AS status FROM ({X.FETCHES})) GROUP BY status""")
def result_statuses(spark, d):
    return pipelines.result_status(X.fixture(spark, X.FETCHES)).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT url FROM ({X.FRONTIER}) WHERE url = 'https://d.test/1'")
def admitted(spark, d):
    known = X.fixture(spark, X.STATE).select("url").unionByName(X.fixture(spark, X.FAILED).select("url"))
    return pipelines.admitted(X.fixture(spark, X.FRONTIER), known, "d.test")


@query(f"SELECT id, ({_news_sql('html')})::INT AS score, ({_news_sql('html')}) >= {C.MIN_NEWS_SCORE} AS news FROM ({X.DATES})")
def news_score(spark, d):
    return X.fixture(spark, X.DATES).select("id", classify.news_score(F.col("html")).cast("int").alias("score"), classify.is_news(F.col("html"), F.col("url")).alias("news"))


@query(f"""SELECT id, {_chain_sql('html', 'url', 't')} AS article_year, {_topic_year_sql('html', 't')} AS topic_year, coalesce(search_year, {_topic_year_sql('html', 't')}) AS chosen,
 coalesce(coalesce(search_year, {_topic_year_sql('html', 't')}) >= {C.MIN_YEAR}, false) AS recent, coalesce({_chain_sql('html', 'url', 't')} = 2026, false) AS this_year, coalesce({_chain_sql('html', 'url', 't')} = 2026, true) AS this_or_none
 FROM (SELECT *, {D.topic_text('html')} AS t FROM ({X.DATES}))""")
def year_chain(spark, d):
    t = F.col("t")
    rows = X.fixture(spark, X.DATES).withColumn("t", text.topic_text(F.col("html")))
    rows = rows.select("id", dates.article_year(F.col("html"), F.col("url"), t).alias("article_year"), dates.topic_year(F.col("html"), t).alias("topic_year"), "search_year").withColumn("chosen", dates.chosen_year(F.col("search_year"), F.col("topic_year")))
    year = F.col("article_year")
    return rows.select("id", "article_year", "topic_year", "chosen", dates.recent(F.col("chosen")).alias("recent"), dates.year_kept(year, 2026).alias("this_year"), dates.year_kept(year, 2026, True).alias("this_or_none"))


@query(_obstacle_sql(f"({X.DATES})", "id"))
def block_reason(spark, d):
    return _obstacles(X.fixture(spark, X.DATES), "id")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_golden_rows(spark, duck, name):
    same_rows(QUERIES[name](spark, DATA), duck.sql(ORACLES[name]))
