"""Queries over files and tables that are written first: readers, writers and state, with what must come back.

Each query writes under the folder for checkpoints, which driver and executors
share, and reads its own files. All files, configurations included, are made of
whole tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.functions import classify, text, urls
from gleanmill.functions import constants as C
from gleanmill.operators import setops
from gleanmill.plans import duck as D
from gleanmill.plans import pipelines
from gleanmill.session import ensure_checkpoint_dir, table
from gleanmill.sources import readers, sinks

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__], ORACLES[f.__name__] = f, sql
        return f

    return add


def folder(spark: SparkSession) -> str:
    """A new place for files."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/written-{uuid.uuid4().hex}"


def lines_of(spark: SparkSession, rows: DataFrame, pos: str) -> str:
    """A folder of text files with the column ``value``, whose lines are read back in the order of ``pos``."""
    path = folder(spark)
    rows.repartitionByRange(pos).sortWithinPartitions(pos).select("value").write.text(path)
    return path


#: A seed file of all pages: a quarter comments, a quarter with blanks around, a quarter blank lines.
SEED_LINES = "CASE page_id % 4 WHEN 0 THEN '# ' || url WHEN 1 THEN '  ' || url || ' ' WHEN 2 THEN '  ' ELSE url END"


def _seeds(spark: SparkSession, d: str) -> str:
    pages = table(spark, d, "pages")
    return lines_of(spark, pages.select("page_id", F.expr(SEED_LINES).alias("value")), "page_id")


@query(f"SELECT row_number() OVER (ORDER BY page_id) AS nth, trim({SEED_LINES}) AS value FROM pages WHERE page_id % 4 IN (1, 3)")
def seed_lines(spark, d):
    """Lines of a seed file in order, without comments and blank ones."""
    return setops.numbered(readers.lines(spark, _seeds(spark, d)), "pos", "nth").select("nth", "value")


@query(f"SELECT trim({SEED_LINES}) AS value, page_id % 4 = 0 AS only_without_comments FROM pages WHERE page_id % 4 <> 2")
def comment_lines(spark, d):
    """The same file read without the rule on comments."""
    every = readers.lines(spark, _seeds(spark, d), comments=False)
    return every.select("value", F.startswith("value", F.lit("#")).alias("only_without_comments"))


@query("""SELECT row_number() OVER (ORDER BY item_id) - 1 AS nth, lower(regexp_extract(text, '[A-Za-z]+', 0)) AS keyword, false AS empty_is_an_error FROM benchmark WHERE regexp_extract(text, '[A-Za-z]+', 0) <> '' UNION ALL SELECT -1, NULL, true""")
def keyword_file(spark, d):
    """The first word of each benchmark item as a keyword file, and a file of comments alone, which is an error."""
    rows = table(spark, d, "benchmark").select("item_id", F.regexp_extract("text", "[A-Za-z]+", 0).alias("value"))
    found = readers.keywords(spark, lines_of(spark, rows, "item_id"))
    try:
        readers.keywords(spark, lines_of(spark, rows.withColumn("value", F.concat(F.lit("# "), "value")), "item_id"))
        failed = False
    except ValueError:
        failed = True
    return spark.createDataFrame([*((i, k, False) for i, k in enumerate(found)), (-1, None, failed)], "nth long, keyword string, empty_is_an_error boolean")


_SOURCE_LINE = "CASE page_id % 4 WHEN 0 THEN host WHEN 1 THEN ' https://WWW.' || host || '/ ' WHEN 2 THEN 'http://www.' || host || '/news/?a=1' ELSE '' END"


@query(f"""SELECT source, row_number() OVER (ORDER BY pos) AS nth FROM (SELECT source, min(page_id) AS pos FROM (SELECT page_id, {D.scheme('l')} || '://' || {D.domain('l')} || rtrim({D.path('l')}, '/') AS source
 FROM (SELECT page_id, CASE WHEN starts_with(v, 'http') THEN v ELSE 'https://' || v END AS l FROM (SELECT page_id, trim({_SOURCE_LINE}) AS v FROM (SELECT page_id, {D.host_raw('url')} AS host FROM pages)) WHERE v <> '')) GROUP BY source)""")
def source_file(spark, d):
    """Hosts of all pages as a source file; the first of equal sources stays, in the order of the file."""
    rows = table(spark, d, "pages").select("page_id", F.regexp_extract("url", "//([^/?#]*)", 1).alias("host")).select("page_id", F.expr(_SOURCE_LINE).alias("value"))
    return setops.numbered(readers.sources(spark, lines_of(spark, rows, "page_id")), "pos", "nth").select("source", "nth")


@query("SELECT DISTINCT url AS url_key, 1 AS files FROM pages WHERE url <> '' UNION ALL SELECT NULL, 0")
def seen_file(spark, d):
    """URLs of all pages, each written twice, and one row without a key for a file that is not there."""
    pages = table(spark, d, "pages").select("page_id", F.col("url").alias("value"))
    there = readers.seen_urls(spark, lines_of(spark, pages.unionByName(pages), "page_id")).withColumn("files", F.lit(1))
    missing = readers.seen_urls(spark, folder(spark)).agg(F.max("url_key").alias("url_key"), F.count(F.lit(1)).cast("int").alias("files"))
    return there.unionByName(missing)


@query(f"""SELECT CASE WHEN length(h) % 2 = 0 THEN 'site ' || h ELSE 'https://' || h END AS name, CASE WHEN length(h) % 2 = 0 THEN 1 ELSE 2 END AS starts, CASE WHEN length(h) % 2 = 0 THEN 'time.d' END AS date_selector,
 CASE WHEN length(h) % 2 = 0 THEN '[0-9]{{4}}' ELSE '20[0-9]{{2}}' END AS date_regex, '%Y' AS date_format, length(h) % 2 <> 0 AS disable_nav_filter FROM (SELECT DISTINCT {D.host_raw('url')} AS h FROM pages)""")
def site_file(spark, d):
    """A configuration with one site for every host, and one without start URLs, which is left out."""
    hosts = sorted(r["h"] for r in table(spark, d, "pages").select(urls.host_raw(F.col("url")).alias("h")).distinct().collect())  # a configuration file
    some = [f'  - {{name: "site {h}", start_urls: ["https://{h}"], date_selector: "time.d"}}' if len(h) % 2 == 0 else f'  - {{start_urls: ["https://{h}", "https://{h}/2"], date_regex: "20[0-9]{{2}}", disable_nav_filter: true}}' for h in hosts]
    text_ = "\n".join(['defaults: {date_regex: "[0-9]{4}", date_format: "%Y"}', "sites:", *some, "  - {name: none}"])
    return readers.sites(spark, text_).select("name", F.size("start_urls").alias("starts"), "date_selector", "date_regex", "date_format", "disable_nav_filter")


@query("SELECT trim(client_id || ' ' || coalesce(city, '')) AS place, coalesce(trim(name), '') AS name FROM clients")
def practitioner_file(spark, d):
    """All clients as a file of places and names with a further field."""
    line = F.concat(F.lit(" "), F.col("client_id").cast("string"), F.lit(" "), F.coalesce("city", F.lit("")), F.lit(" ; "), F.coalesce("name", F.lit("")), F.lit(";more"))
    path = folder(spark)
    table(spark, d, "clients").select(line.alias("value")).write.text(path)
    return readers.practitioners(spark, path).select("place", F.coalesce("name", F.lit("")).alias("name"))


@query("""SELECT * FROM (SELECT 'article' AS kind, 'https://h.test/' || page_id AS url, CASE WHEN page_id % 3 = 0 THEN 'saved' WHEN page_id % 3 = 1 THEN 'skipped_year' ELSE 'error' END AS status, CASE WHEN page_id % 3 = 0 THEN 'page_' || page_id || '.html' END AS file, NULL::BIGINT AS links FROM pages
 UNION ALL SELECT 'listing', url, NULL, NULL, 2 FROM (SELECT DISTINCT url FROM pages))""")
def journal_entries(spark, d):
    """A journal of all pages, saved and read back: articles and listings apart."""
    articles, listings = readers.journal(spark, _journal(spark, d))
    both = articles.select(F.lit("article").alias("kind"), "url", "status", "file", F.lit(None).cast("long").alias("links"))
    return both.unionByName(listings.select(F.lit("listing").alias("kind"), "url", F.lit(None).cast("string").alias("status"), F.lit(None).cast("string").alias("file"), (F.size("articles") + F.size("pagination")).cast("long").alias("links")))


def _journal(spark: SparkSession, d: str) -> str:
    pages = table(spark, d, "pages")
    n = F.col("page_id") % 3
    articles = pages.select(
        F.concat(F.lit("https://h.test/"), F.col("page_id").cast("string")).alias("url"),
        F.when(n == 0, F.lit("saved")).when(n == 1, F.lit("skipped_year")).otherwise(F.lit("error")).alias("status"),
        F.lit(200).alias("code"), F.lit(2025).alias("year"),
        F.when(n == 0, F.concat(F.lit("page_"), F.col("page_id").cast("string"), F.lit(".html"))).alias("file"), F.lit(None).cast("string").alias("message"),
    )
    listings = pages.select("url").distinct().select("url", F.array(F.lit("a")).alias("articles"), F.array(F.lit("b")).alias("pagination"))
    path = folder(spark)
    sinks.write_journal(articles, listings, path)
    return path


@query("SELECT count(*) AS visited, count(*) FILTER (WHERE page_id % 3 = 0) AS saved, count(*) FILTER (WHERE page_id % 3 = 1) AS skipped_year, count(*) FILTER (WHERE page_id % 3 = 2) AS errors, count(*) FILTER (WHERE page_id % 3 < 2) AS resumed FROM pages")
def journal_report(spark, d):
    """Counts of a journal, and the entries that a second run would leave alone."""
    articles, _ = readers.journal(spark, _journal(spark, d))
    return pipelines.journal_report(articles)


@query("SELECT 'https://h.test/' || page_id AS url, 'page_' || page_id || '.html' AS file FROM pages WHERE page_id % 3 = 0")
def saved_files(spark, d):
    articles, _ = readers.journal(spark, _journal(spark, d))
    return pipelines.saved_files(articles)


@query("SELECT count(*) FILTER (WHERE quality = 1) AS saved, count(*) FILTER (WHERE quality = 0) AS ignored, count(*) FILTER (WHERE quality IS NULL) AS errors FROM documents LEFT JOIN labels USING (doc_id)")
def crawl_summary(spark, d):
    labels = table(spark, d, "labels").select("doc_id", "quality")
    state = F.when(F.col("quality") == 1, F.lit("saved")).when(F.col("quality") == 0, F.lit("ignored")).otherwise(F.lit("error"))
    return pipelines.crawl_summary(table(spark, d, "documents").select("doc_id").join(labels, "doc_id", "left").select(state.alias("outcome")))


@query("SELECT page_id::VARCHAR AS uuid, url, NULL::DOUBLE AS score, 0 AS n_found FROM pages")
def migrated_state(spark, d):
    """A state that was written before it had scores, read under the newer schema; a state that is not there is empty."""
    path = folder(spark)
    old = table(spark, d, "pages").select(F.col("page_id").cast("string").alias("uuid"), "url")
    sinks.append(sinks.with_columns_of(old, {"score": "double", "mots_cles_trouves": "array<string>"}), path)
    none = readers.state(spark, folder(spark), readers.PAGES_STATE).filter("url IS NOT NULL")
    rows = readers.state(spark, path, readers.PAGES_STATE).unionByName(none)
    return rows.select("uuid", "url", "score", F.greatest(F.lit(0), F.size(F.coalesce("mots_cles_trouves", F.array().cast("array<string>")))).alias("n_found"))


@query("SELECT source AS domaine, '404' AS code_http, count(*) AS n FROM documents GROUP BY source")
def error_rows(spark, d):
    """Error rows appended twice, half of the table each time."""
    path = folder(spark)
    rows = table(spark, d, "documents").select(F.concat(F.lit("https://e.test/"), F.col("doc_id").cast("string")).alias("url"), F.col("source").alias("domaine"), F.lit("404").alias("code_http"), F.lit("x").alias("message"), F.lit(None).cast("timestamp").alias("date"), "doc_id")
    for half in (0, 1):
        sinks.append(rows.filter(F.col("doc_id") % 2 == half).drop("doc_id"), path)
    return readers.state(spark, path, readers.ERRORS).groupBy("domaine", "code_http").agg(F.count(F.lit(1)).alias("n"))


SCORED = ["the", "und", "que"]


@query(f"SELECT page_id::VARCHAR AS uuid, {D.keyword_score('lower(' + D.page_text('html', C.SCORER_TAGS) + ')', SCORED)} AS score FROM pages")
def score_update(spark, d):
    """The state with new scores beside it, joined by key; nothing is changed in place."""
    pages = table(spark, d, "pages")
    state = sinks.with_columns_of(pages.select(F.col("page_id").cast("string").alias("uuid"), "url"), {"score": "double"})
    scores = pages.select(F.col("page_id").cast("string").alias("uuid"), text.keyword_score(text.scorer_text(F.col("html")), SCORED).alias("score"))
    path = folder(spark)
    sinks.append(sinks.updated(state, scores, "uuid", "score"), path)
    return spark.read.parquet(path).select("uuid", "score")


@query("SELECT CASE WHEN quality = 1 THEN 'kept' ELSE 'rejected' END AS outcome, count(*) AS n FROM labels GROUP BY 1")
def outcome_folders(spark, d):
    """One folder per outcome, written twice: the second time replaces the first."""
    path = folder(spark)
    rows = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, F.lit("kept")).otherwise(F.lit("rejected")).alias("outcome"))
    sinks.write_outcomes(rows.withColumn("outcome", F.lit("old")), path)
    sinks.write_outcomes(rows, path)
    return spark.read.parquet(path).groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT page_id, sha256(url) AS uuid FROM pages")
def blob_names(spark, d):
    return sinks.blob_ids(table(spark, d, "pages")).select("page_id", "uuid")


_SAVED = " UNION ALL ".join(f"SELECT 'page_' || row_number() OVER (ORDER BY page_id) || '.{kind}' AS name, '{kind}' AS type_read, octet_length(encode(html))::BIGINT AS bytes FROM pages WHERE page_id % 3 = {n}" for n, kind in enumerate(("html", "css", "png")))


@query(_SAVED)
def saved_contents(spark, d):
    """Contents saved under their numbers with the suffix of their type, read back as blobs."""
    path = folder(spark)
    n = F.col("page_id") % 3
    kind = F.when(n == 0, F.lit("text/html; charset=utf-8")).when(n == 1, F.lit("text/css")).otherwise(F.lit("image/png"))
    rows = table(spark, d, "pages").select("page_id", "url", kind.alias("content_type"), F.encode("html", "UTF-8").alias("content"))
    from pyspark.sql import Window

    named = rows.withColumn("nth", F.row_number().over(Window.partitionBy("content_type").orderBy("page_id")))
    named = named.withColumn("name", F.concat(F.lit("page_"), F.col("nth").cast("string"), classify.guess_suffix(F.col("content_type"), F.col("url"))))
    sinks.write_contents(named.filter(classify.size_allowed(F.col("content"))), path)
    return readers.blobs(spark, path).select(F.concat("uuid", F.lit("."), "type").alias("name"), F.col("type").alias("type_read"), F.length("content").cast("long").alias("bytes"))


@query("SELECT 'DOC' AS kind, count(*) AS blocks, count(*) AS rules FROM documents")
def log_file(spark, d):
    """One log block per document, appended; each ends with a rule."""
    path = folder(spark)
    rows = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("url"), F.lit("SUCCESS").alias("status"))
    sinks.write_log(rows, path)
    lines = spark.read.text(path)
    return lines.agg(F.count_if(F.col("value").startswith("URL : ")).alias("blocks"), F.count_if(F.col("value") == "-" * 60).alias("rules")).select(F.lit("DOC").alias("kind"), "blocks", "rules")


@query(f"SELECT DISTINCT {D.seen_key('url')} AS url_key FROM pages WHERE page_id % 2 = 0 AND {D.seen_key('url')} NOT IN (SELECT {D.seen_key('url')} FROM pages WHERE page_id % 4 = 0)")
def seen_appended(spark, d):
    """Keys of successes that a history does not have, appended to a file and read back."""
    rows = table(spark, d, "pages").withColumn("url_key", urls.seen_key(F.col("url")))
    history = rows.filter("page_id % 4 = 0").select("url_key")
    visited = rows.select("url_key", F.col("url_key").alias("final_key"), F.when(F.col("page_id") % 2 == 0, F.lit("SUCCESS")).otherwise(F.lit("OPEN_ERROR")).alias("status"))
    path = folder(spark)
    sinks.append_seen(visited, history, path, large=True)
    return readers.seen_urls(spark, path)


@query(f"SELECT count(*) AS titles, count(*) - 1 AS rules, count(*) AS sources FROM pages WHERE {D.squeeze(D.unescape('regexp_extract(html, ' + chr(39) + '(?is)<title[^>]*>(.*?)</title>' + chr(39) + ', 1)'))} <> ''")
def markdown_file(spark, d):
    """Articles that have a title or a text as one Markdown file."""
    none = F.lit(None).cast("string")
    rows = table(spark, d, "pages").select(F.col("page_id").alias("pos"), "url", text.title(F.col("html")).alias("title"), none.alias("date"), none.alias("authors"), none.alias("description"), none.alias("text"))
    path = folder(spark)
    sinks.write_markdown(rows.filter(classify.non_empty_article(F.col("title"), F.col("text"))), path)
    lines = spark.read.text(path)
    return lines.agg(F.count_if(F.col("value").startswith("# ")).alias("titles"), F.count_if(F.col("value") == "---").alias("rules"), F.count_if(F.col("value").startswith("**Source :**")).alias("sources"))


@query("SELECT doc_id, coalesce(trim(text), '') AS safe, length(coalesce(text, '')) > 0 AS filled FROM documents")
def safe_text(spark, d):
    rows = table(spark, d, "documents")
    return rows.select("doc_id", text.safe(F.col("text")).alias("safe"), classify.non_empty_article(F.lit(None).cast("string"), F.col("text")).alias("filled"))
