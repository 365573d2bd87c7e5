"""All queries of the library by name, with DuckDB SQL for the same rows.

Queries read whole tables, or rows that both engines derive from them
(``plans/derived.py``) where the tables cannot show a case by themselves.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.functions import classify, dates, text, urls
from gleanmill.functions import constants as C
from gleanmill.operators import html_trees, setops
from gleanmill.plans import duck as D
from gleanmill.plans import deep, derived, pipelines, written
from gleanmill.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

KEYWORDS = ["the", "und", "pour", "tion", "que", "heit", "ment", "zzz", "ing that", "mente"]
TOPIC = [["the", "die", "le"], ["ing", "heit", "tion"], ["on"]]


def query(sql: str | None = None):
    """Register a function under its name, with its SQL where there is one."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def _pages(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "pages")


def _docs(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


# --- documents: keyword scores, words, topics ---------------------------------


@query(f"SELECT doc_id, {D.keyword_score('lower(coalesce(text, chr(32)))', KEYWORDS)} AS score FROM documents")
def kw_score(spark, d):
    return _docs(spark, d).select("doc_id", text.keyword_score(F.col("text"), KEYWORDS).alias("score"))


@query(f"""SELECT CASE WHEN score >= {C.MIN_SCORE} THEN 'kept' ELSE 'rejected' END AS outcome, count(*) AS n, round(max(score), 4) AS best
FROM (SELECT {D.keyword_score('lower(coalesce(text, chr(32)))', KEYWORDS)} AS score FROM documents) GROUP BY 1""")
def kw_score_summary(spark, d):
    scored = kw_score(spark, d)
    outcome = F.when(F.col("score") >= C.MIN_SCORE, F.lit("kept")).otherwise(F.lit("rejected"))
    return scored.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"), F.round(F.max("score"), 4).alias("best"))


@query(f"SELECT doc_id, array_to_string({D.keywords_found('lower(text)', KEYWORDS)}, ', ') AS found FROM documents")
def kw_found_list(spark, d):
    return _docs(spark, d).select("doc_id", F.array_join(text.keywords_found(F.col("text"), KEYWORDS), ", ").alias("found"))


@query(f"SELECT doc_id, {D.word_count('text')}::BIGINT AS words, ({D.blank_count('text')})::BIGINT AS blank_words FROM documents")
def word_counts(spark, d):
    t = F.col("text")
    return _docs(spark, d).select("doc_id", text.word_count(t).cast("long").alias("words"), text.blank_count(t).cast("long").alias("blank_words"))


@query("SELECT doc_id, " + " AND ".join("(" + " OR ".join(f"contains(t, '{x}')" for x in g) + ")" for g in TOPIC) + f" AS on_topic FROM (SELECT doc_id, {D.squeeze('lower(text)')} AS t FROM documents)")
def topic_match(spark, d):
    return _docs(spark, d).select("doc_id", text.matches_topic(F.col("text"), TOPIC).alias("on_topic"))


# --- URLs ----------------------------------------------------------------------


@query(f"SELECT page_id, {D.basic('url')} AS u FROM pages")
def url_basic(spark, d):
    return _pages(spark, d).select("page_id", urls.basic(F.col("url")).alias("u"))


@query(f"SELECT page_id, {D.seen_key('url')} AS u FROM pages")
def url_seen_key(spark, d):
    return _pages(spark, d).select("page_id", urls.seen_key(F.col("url")).alias("u"))


@query(f"SELECT page_id, {D.canonical('url')} AS u FROM pages")
def url_canonical(spark, d):
    return _pages(spark, d).select("page_id", urls.canonical(F.col("url")).alias("u"))


@query(f"SELECT page_id, {D.host_raw('url')} AS host_raw, lower({D.host_raw('url')}) AS host, {D.domain('url')} AS domain FROM pages")
def url_domain(spark, d):
    return _pages(spark, d).select("page_id", urls.host_raw(F.col("url")).alias("host_raw"), urls.host(F.col("url")).alias("host"), urls.domain(F.col("url")).alias("domain"))


@query(f"SELECT page_id, {D.pagination('url')} AS pagination, {D.article_candidate('url')} AS candidate, {D.any_of('url', C.SAVE_PATTERNS)} AS save, ({D.suffix('url')} = '' OR list_contains({D.lits(C.ALLOWED_SUFFIXES)}, {D.suffix('url')})) AS suffix_ok, {D.any_of('lower(url)', C.EXCLUDED_PARTS)} AS excluded FROM pages")
def url_predicates(spark, d):
    return _pages(spark, d).select("page_id", urls.pagination_url(F.col("url")).alias("pagination"), urls.article_candidate(F.col("url")).alias("candidate"), urls.save_pattern(F.col("url")).alias("save"), urls.suffix_allowed(F.col("url")).alias("suffix_ok"), urls.excluded(F.col("url")).alias("excluded"))


_LINKS_SQL = "SELECT page_id, url, unnest(list_filter(list_transform(regexp_extract_all(html, '(?i)<a\\s[^>]*?href\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1), lambda x: trim(x)), lambda x: x <> '' AND NOT regexp_matches(lower(x), '^(mailto:|javascript:|tel:|#)'))) AS link FROM pages"
_RESOLVED_SQL = f"SELECT page_id, url, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || link AS target FROM ({_LINKS_SQL}) WHERE starts_with(link, '/') AND NOT contains(link, ' ')"


def _links(spark, d):
    return _pages(spark, d).select("page_id", "url", F.explode(urls.links(F.col("html"))).alias("link")).withColumn("target", urls.resolve(F.col("link"), F.col("url"))).filter("target IS NOT NULL")


@query(f"SELECT DISTINCT page_id, target FROM ({_RESOLVED_SQL})")
def link_explode(spark, d):
    return _links(spark, d).select("page_id", "target").distinct()


@query(f"SELECT page_id, count(DISTINCT target) AS n_links, count(DISTINCT target) >= {C.MIN_LISTING_LINKS} AS listing FROM ({_RESOLVED_SQL}) WHERE NOT {D.any_of(f'lower({D.path(chr(116) + chr(97) + chr(114) + chr(103) + chr(101) + chr(116))})', C.NAVIGATION_PARTS)} AND length(trim({D.path('target')}, '/')) >= 3 GROUP BY page_id")
def editorial_listing_flag(spark, d):
    kept = _links(spark, d).filter(urls.editorial_link(F.col("target"), F.col("url")))
    counted = kept.groupBy("page_id").agg(F.count_distinct("target").alias("n_links"))
    return counted.withColumn("listing", classify.is_listing(F.col("n_links")))


@query(f"""SELECT route, count(*) AS n FROM (SELECT DISTINCT page_id, {D.basic('target')} AS t, CASE WHEN {D.domain(D.basic('target'))} <> {D.domain('url')} THEN 'off_domain' WHEN {D.pagination(D.basic('target'))} THEN 'pagination'
 WHEN {D.article_candidate(D.basic('target'))} THEN 'article' ELSE 'none' END AS route FROM ({_RESOLVED_SQL})) GROUP BY route""")
def url_route_counts(spark, d):
    found = _links(spark, d).withColumn("t", urls.basic(F.col("target"))).withColumn("route", urls.route(F.col("t"), urls.domain(F.col("url"))))
    return found.select("page_id", "t", "route").distinct().groupBy("route").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT {D.host_raw('url')} AS key, list(url ORDER BY page_id) AS pages FROM pages GROUP BY 1")
def pages_by_domain(spark, d):
    return setops.grouped_in_order(_pages(spark, d), urls.host_raw(F.col("url")), "page_id", "url", "pages")


# --- pages ---------------------------------------------------------------------


@query(f"SELECT page_id, lower({D.page_text('html', C.SCORER_TAGS)}) AS t FROM pages")
def html_text_scorer(spark, d):
    return _pages(spark, d).select("page_id", text.scorer_text(F.col("html")).alias("t"))


@query(f"SELECT page_id, {D.topic_text('html')} AS t FROM pages")
def html_text_topics(spark, d):
    return _pages(spark, d).select("page_id", text.topic_text(F.col("html")).alias("t"))


_REASON_SQL = f"""SELECT page_id, html, CASE WHEN w < {C.MIN_WORDS_PAGE} THEN 'trop court (' || w || ' mots < {C.MIN_WORDS_PAGE})'
 WHEN len(p) > 0 AND list_sum(list_transform(p, lambda x: len(string_split(x, ' '))))::DOUBLE / len(p) < {C.MIN_WORDS_PARAGRAPH} THEN 'paragraphes trop courts' END AS reason
 FROM (SELECT page_id, html, {D.blank_count(D.page_text('html', C.SCORER_TAGS))} AS w, {D.paragraphs('html')} AS p FROM pages)"""


@query(f"SELECT page_id, reason FROM ({_REASON_SQL})")
def struct_filter(spark, d):
    return _pages(spark, d).select("page_id", classify.reject_reason(F.col("html")).alias("reason"))


@query(f"SELECT page_id, CASE WHEN len(p) > 0 THEN list_sum(list_transform(p, lambda x: len(string_split(x, ' '))))::DOUBLE / len(p) END AS mean, len(p)::BIGINT AS n, array_to_string(p[1:5], chr(10)) AS preview FROM (SELECT page_id, {D.paragraphs('html')} AS p FROM pages)")
def paragraph_stats(spark, d):
    rows = _pages(spark, d).select("page_id", text.paragraphs(F.col("html")).alias("p"))
    return rows.select("page_id", text.mean_words(F.col("p")).alias("mean"), F.size("p").cast("long").alias("n"), F.array_join(F.slice("p", 1, 5), "\n").alias("preview"))


@query(f"""SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN reason IS NOT NULL THEN 'rejected_structure' WHEN {D.keyword_score('t', KEYWORDS)} < {C.MIN_SCORE} THEN 'rejected_score' ELSE 'kept' END AS outcome
 FROM (SELECT reason, lower({D.page_text('html', C.SCORER_TAGS)}) AS t FROM ({_REASON_SQL}))) GROUP BY outcome""")
def scorer_summary(spark, d):
    return pipelines.score_pages(_pages(spark, d), KEYWORDS).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


_SAVED_PAGES = "SELECT page_id, CASE WHEN contains(url, '?') THEN NULL ELSE html END AS html FROM {pages}"


@query(f"""SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN html IS NULL THEN 'missing_blob' WHEN reason IS NOT NULL THEN 'rejected_structure' WHEN {D.keyword_score('t', KEYWORDS)} < {C.MIN_SCORE} THEN 'rejected_score' ELSE 'kept' END AS outcome
 FROM (SELECT html, reason, lower({D.page_text('html', C.SCORER_TAGS)}) AS t FROM ({_REASON_SQL.replace('FROM pages', 'FROM ' + derived.duck(_SAVED_PAGES))}))) GROUP BY outcome""")
def scorer_summary_blobs(spark, d):
    """The same where pages with a query in their URL have lost their content."""
    return pipelines.score_pages(derived.derived(spark, d, _SAVED_PAGES), KEYWORDS).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def _news_sql(h: str) -> str:
    types = f"list_transform({D.json_blocks(h)}, lambda b: coalesce(json_extract(b, '$.\"@type\"')::VARCHAR, ''))"
    hits = f"len(list_filter({types}, lambda t: {D.any_of('t', C.ARTICLE_TYPES)}))"
    on = lambda c, n: f"CASE WHEN coalesce({c}, false) THEN {n} ELSE 0 END"
    parts = [
        f"{hits} * 4", on(f"contains(lower({D.meta(h, 'property', 'og:type')}), 'article')", 3), on(f"regexp_matches({h}, '(?i)<article[\\s>]')", 2),
        on(f"regexp_matches({h}, '(?i)<time[\\s>]') OR {D.has_class(h, C.DATE_CLASS)}", 2),
        on(f"regexp_matches({h}, '(?is)<[a-z][^>]*\\srel\\s*=\\s*[\"''][^\"'']*\\bauthor\\b') OR {D.has_class(h, C.AUTHOR_CLASS)}", 1),
        on(f"regexp_matches({h}, '(?is)<meta\\s[^>]*name\\s*=\\s*[\"'']author[\"'']')", 1), on(D.has_class(h, C.BODY_CLASS), 2),
    ]
    return " + ".join(parts)


@query(f"SELECT id, ({_news_sql('html')})::INT AS score, ({_news_sql('html')}) >= {C.MIN_NEWS_SCORE} AS news FROM {derived._DATES}")
def news_score(spark, d):
    return derived.dated(spark, d).select("id", classify.news_score(F.col("html")).cast("int").alias("score"), classify.is_news(F.col("html"), F.col("url")).alias("news"))


@query(f"SELECT page_id, ({_news_sql('html')})::INT AS score FROM pages")
def news_score_pages(spark, d):
    return _pages(spark, d).select("page_id", classify.news_score(F.col("html")).cast("int").alias("score"))


def _chain_sql(h: str, u: str, t: str) -> str:
    block = f"list_filter(list_transform({D.json_blocks(h)}, lambda b: coalesce({', '.join(D.first_year(f'json_extract_string(b, {chr(39)}$.{k}{chr(39)})') for k in C.JSON_DATE_KEYS)})), lambda y: y IS NOT NULL)[1]"
    time = f"regexp_extract({h}, '(?is)<time\\s[^>]*datetime\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1)"
    steps = [block, D.first_year(D.meta(h, "property", "article:published_time")), *[D.first_year(D.meta(h, "name", n)) for n in C.META_NAMES_LISTING], D.first_year(time)]
    steps += [f"nullif(regexp_extract({u}, '/(20\\d{{2}})[/\\-]', 1), '')::INT", D.first_year(f"regexp_extract({t}, '{C.DATE_REGEX}', 0)"), f"nullif(regexp_extract({u}, '\\b(20\\d{{2}})', 1), '')::INT"]
    return f"coalesce({', '.join(steps)})"


def _topic_year_sql(h: str, t: str) -> str:
    times = f"list_filter(list_transform(regexp_extract_all({h}, '(?is)<time\\b[^>]*>.*?</time>', 0), lambda x: {D.largest_year('(regexp_extract(x, ' + chr(39) + '(?is)datetime\\s*=\\s*[\"' + chr(39) * 2 + ']([^\"' + chr(39) * 2 + ']*)[\"' + chr(39) * 2 + ']' + chr(39) + ', 1) || chr(32) || regexp_replace(x, ' + chr(39) + '<[^>]*>' + chr(39) + ', chr(32), ' + chr(39) + 'g' + chr(39) + '))')}), lambda y: y IS NOT NULL)[1]"
    blocks = f"list_filter(list_transform({D.json_blocks(h)}, lambda b: {D.largest_year('b')}), lambda y: y IS NOT NULL)[1]"
    return f"coalesce({', '.join(D.largest_year(D.meta(h, a, n)) for a, n in C.META_DATES_TOPIC)}, {times}, {blocks}, {D.largest_year(t)})"


@query(f"""SELECT id, {_chain_sql('html', 'url', 't')} AS article_year, {_topic_year_sql('html', 't')} AS topic_year, coalesce(search_year, {_topic_year_sql('html', 't')}) AS chosen,
 coalesce(coalesce(search_year, {_topic_year_sql('html', 't')}) >= {C.MIN_YEAR}, false) AS recent, coalesce({_chain_sql('html', 'url', 't')} = 2026, false) AS this_year, coalesce({_chain_sql('html', 'url', 't')} = 2026, true) AS this_or_none
 FROM (SELECT *, {D.topic_text('html')} AS t FROM {derived._DATES})""")
def year_chain(spark, d):
    t = F.col("t")
    rows = derived.dated(spark, d).withColumn("t", text.topic_text(F.col("html")))
    rows = rows.select("id", dates.article_year(F.col("html"), F.col("url"), t).alias("article_year"), dates.topic_year(F.col("html"), t).alias("topic_year"), "search_year").withColumn("chosen", dates.chosen_year(F.col("search_year"), F.col("topic_year")))
    year = F.col("article_year")
    return rows.select("id", "article_year", "topic_year", "chosen", dates.recent(F.col("chosen")).alias("recent"), dates.year_kept(year, 2026).alias("this_year"), dates.year_kept(year, 2026, True).alias("this_or_none"))


@query(f"SELECT page_id, {_chain_sql('html', 'url', 't')} AS year, {D.largest_year('t')} AS in_text FROM (SELECT *, {D.topic_text('html')} AS t FROM pages)")
def year_pages(spark, d):
    t = F.col("t")
    return _pages(spark, d).withColumn("t", text.topic_text(F.col("html"))).select("page_id", dates.article_year(F.col("html"), F.col("url"), t).alias("year"), dates.largest_year(t).alias("in_text"))


@query(f"SELECT o_orderkey, {D.largest_year('t')} AS year, {D.first_year('t')} AS first_year FROM (SELECT o_orderkey, 'du ' || o_orderdate::DATE || ' au 2001, ' || o_orderkey AS t FROM orders)")
def year_max_text(spark, d):
    t = F.concat(F.lit("du "), F.col("o_orderdate").cast("date").cast("string"), F.lit(" au 2001, "), F.col("o_orderkey").cast("string"))
    return table(spark, d, "orders").select("o_orderkey", dates.largest_year(t).alias("year"), dates.first_year(t).alias("first_year"))


_LOW = "lower(html)"
_PLAIN = "lower(regexp_replace(html, '(?s)<[a-zA-Z/!][^>]*>', '', 'g'))"


def _obstacle_sql(source: str, key: str) -> str:
    first = " ".join(f"WHEN {D.any_of(t, signs)} THEN '{name}'" for name, t, signs in (("block", _LOW, C.BLOCK_SIGNS), ("captcha", _LOW, C.CAPTCHA_SIGNS), ("login", _LOW, C.LOGIN_SIGNS), ("consent", _PLAIN, C.CONSENT_SIGNS)))
    return f"""SELECT {key}, CASE {first} END AS first, {D.any_of(_LOW, C.BLOCK_SIGNS)} AS block, {D.any_of(_LOW, C.CAPTCHA_SIGNS)} AS captcha, {D.any_of(_LOW, C.LOGIN_SIGNS)} AS login, {D.any_of(_PLAIN, C.CONSENT_SIGNS)} AS consent FROM {source}"""


def _obstacles(rows: DataFrame, key: str) -> DataFrame:
    return rows.select(key, classify.obstacle(F.col("html")).alias("first"), classify.is_block(F.col("html")).alias("block"), classify.is_captcha(F.col("html")).alias("captcha"), classify.is_login_wall(F.col("html")).alias("login"), classify.is_consent(F.col("html")).alias("consent"))


@query(_obstacle_sql(derived._DATES, "id"))
def block_reason(spark, d):
    return _obstacles(derived.dated(spark, d), "id")


@query(_obstacle_sql("pages", "page_id"))
def block_reason_pages(spark, d):
    return _obstacles(_pages(spark, d), "page_id")


@query("SELECT page_id, regexp_replace(html, '(?i)(<head(?:\\s[^>]*)?>)', '\\1<base href=\"' || url || '\"/>') AS html FROM pages")
def base_tag(spark, d):
    return _pages(spark, d).select("page_id", text.with_base(F.col("html"), F.col("url")).alias("html"))


@query(f"SELECT page_id, '# ' || {D.squeeze(D.unescape('regexp_extract(html, ' + chr(39) + '(?is)<title[^>]*>(.*?)</title>' + chr(39) + ', 1)'))} || chr(10) || chr(10) || '**Source :** ' || url || chr(10) AS md FROM pages")
def markdown_render(spark, d):
    none = F.lit(None).cast("string")
    return _pages(spark, d).select("page_id", text.markdown(text.title(F.col("html")), none, none, F.col("url"), none, none).alias("md"))


@query()
def editorial_links(spark, d):
    return html_trees.editorial_links(_pages(spark, d))


@query(f"""SELECT page_id, {D.squeeze(D.unescape('regexp_extract(html, ' + chr(39) + '(?is)<title[^>]*>(.*?)</title>' + chr(39) + ', 1)'))} AS title, array_to_string({D.paragraphs("regexp_replace(html, '(?is)<br[^>]*>', ' ', 'g')")}, chr(10)) AS text FROM pages""")
def article_parts(spark, d):
    return html_trees.articles(_pages(spark, d)).select("page_id", "title", "text")


def _fake_judge(prompts: list[str]) -> list[str | None]:
    """A judge for tests: by words of the text, wrapped in prose, or unreadable."""
    out = []
    for prompt in prompts:
        shown = prompt.rpartition("\n\n")[2] if "\n\n" in prompt else prompt
        flag = "true" if "tion" in shown else "false"
        out.append(None if shown.startswith("D") else "no idea" if shown.startswith("E") else f'Voici : {{"interessant": {flag}}} !')
    return out


@query(f"SELECT doc_id AS id, NOT regexp_matches(t, '^[DE]') AND contains(t, 'tion') AS interesting FROM (SELECT doc_id, replace(left(coalesce(text, ''), {C.JUDGE_CHARS}), chr(10), ' ') AS t FROM documents)")
def judge_answers(spark, d):
    """Answers of a judge that runs in the tasks; what can't be read counts as false."""
    return html_trees.interest(_docs(spark, d).select(F.col("doc_id").alias("id"), F.translate("text", "\n", " ").alias("text")), _fake_judge)


# --- joins, dedupe, ranking -----------------------------------------------------


@query(f"""SELECT page_id, outcome FROM (SELECT page_id, CASE WHEN x THEN 'excluded' WHEN row_number() OVER (PARTITION BY k, x ORDER BY page_id) > 1 THEN 'duplicate' ELSE 'kept' END AS outcome
 FROM (SELECT page_id, k, {D.any_of('lower(k)', C.EXCLUDED_PARTS)} AS x FROM (SELECT page_id, {D.canonical('url')} AS k FROM pages UNION ALL SELECT page_id + 1000000, {D.canonical('url')} FROM pages)))""")
def exclude_then_dedupe(spark, d):
    rows = _pages(spark, d).select(F.col("page_id").alias("pos"), "url")
    both = setops.union_in_order(rows, rows.withColumn("pos", F.col("pos") + 1000000))
    return setops.exclude_then_dedupe(both, "url", "part_pos").select(F.col("pos").alias("page_id"), "outcome")


@query("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' AND l_orderkey IS NOT NULL)")
def state_antijoin_orders(spark, d):
    """The whole of a history that grows with the input: orders of which no line was returned."""
    returned = table(spark, d, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("o_orderkey"))
    return setops.unseen(table(spark, d, "orders"), "o_orderkey", returned).select("o_orderkey")


@query("SELECT source, doc_id, rank FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS rank FROM documents) WHERE rank <= 5")
def topk_per_site(spark, d):
    return setops.top_per_group(_docs(spark, d), "source", "doc_id", C.MAX_PER_SOURCE).select("source", "doc_id", "rank")


@query(f"SELECT doc_id FROM documents ORDER BY doc_id LIMIT {C.MAX_GLOBAL}")
def global_limit(spark, d):
    return setops.first_rows(_docs(spark, d).select("doc_id"), "doc_id", C.MAX_GLOBAL)


@query("SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS n FROM documents")
def global_numbers_all(spark, d):
    """Numbers of all documents, whatever their language."""
    return setops.numbered(_docs(spark, d).select("doc_id"), "doc_id")


@query("SELECT DISTINCT source AS domain, 'site:' || source || ' (the OR die OR le) AND (ing OR heit OR tion) AND on' AS query FROM documents")
def site_query_product(spark, d):
    return setops.site_queries(_docs(spark, d).select(F.col("source").alias("domain")).distinct(), TOPIC)


def _edges(spark, d):
    pages = _pages(spark, d).select("url", "html")
    return pages.select(F.col("url").alias("src"), F.explode(urls.links(F.col("html"))).alias("link")).select("src", urls.resolve(F.col("link"), F.col("src")).alias("dst")).filter("dst IS NOT NULL").distinct()


@query(f"SELECT url, min(depth) AS depth FROM (SELECT url, 0 AS depth FROM pages UNION ALL SELECT target, 1 FROM ({_RESOLVED_SQL})) GROUP BY url")
def frontier_depth1(spark, d):
    return setops.reachable(_pages(spark, d).select("url"), _edges(spark, d), 1)


# --- flows ----------------------------------------------------------------------


_SHOWN_YEAR = "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE 2020 + n_chars % 8 END"


@query(f"""SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN NOT ({" AND ".join("(" + " OR ".join(f"contains(t, '{x}')" for x in g) + ")" for g in TOPIC)}) THEN 'rejected_topic' WHEN w < {C.MIN_WORDS_TOPIC} THEN 'rejected_short'
 WHEN year IS NULL THEN 'rejected_no_date' WHEN year < {C.MIN_YEAR} THEN 'rejected_old' WHEN coalesce(quality, 0) <> 1 THEN 'rejected_judge' ELSE 'html_saved' END AS outcome FROM (SELECT {D.squeeze('lower(text)')} AS t, {D.word_count('text')} AS w, quality, {_SHOWN_YEAR} AS year FROM documents LEFT JOIN labels USING (doc_id))) GROUP BY outcome""")
def funnel_documents(spark, d):
    """The funnel over all texts, with a year that each document has by its id and length, or none."""
    t = F.col("text")
    labels = table(spark, d, "labels").select("doc_id", (F.col("quality") == 1).alias("interesting"))
    rows = _docs(spark, d).select("doc_id", text.matches_topic(t, TOPIC).alias("on_topic"), text.word_count(t).alias("words"), F.expr(_SHOWN_YEAR).alias("year")).join(labels, "doc_id", "left")
    outcome = pipelines.html_outcome(F.col("on_topic"), F.col("words"), F.col("year"), F.col("interesting"))
    return rows.groupBy(outcome.alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query(f"""SELECT page_id, CASE WHEN ({_news_sql('html')}) < {C.MIN_NEWS_SCORE} THEN 'not_article' WHEN {_chain_sql('html', 'url', 't')} IS DISTINCT FROM 2026 THEN 'skipped_year' ELSE 'saved' END AS outcome FROM (SELECT *, {D.topic_text('html')} AS t FROM pages)""")
def visit_outcomes(spark, d):
    rows = _pages(spark, d).select("page_id", F.lit(200).alias("code"), classify.news_score(F.col("html")).alias("news_score"), dates.article_year(F.col("html"), F.col("url"), text.topic_text(F.col("html"))).alias("year"))
    return pipelines.visit_outcome(rows, 2026).select("page_id", "outcome")


@query("SELECT source, string_agg(doc_id::VARCHAR, ', ' ORDER BY doc_id) AS docs FROM documents GROUP BY source")
def string_agg_all(spark, d):
    """The lists of all documents, that of the hot source included."""
    return _docs(spark, d).groupBy("source").agg(F.expr("listagg(CAST(doc_id AS STRING), ', ') WITHIN GROUP (ORDER BY doc_id)").alias("docs"))


for more in (written, deep, derived):
    QUERIES.update(more.QUERIES)
    ORACLES.update(more.ORACLES)
