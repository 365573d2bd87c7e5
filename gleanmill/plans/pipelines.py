"""Flows: every input row gets exactly one outcome."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmill.functions import classify, dates, text, urls
from gleanmill.functions import constants as C
from gleanmill.operators import keywords as automaton
from gleanmill.operators.setops import mark_first

FUNNEL = ["excluded", "duplicate", "download_error", "other_skipped", "pdf_saved", "rejected_topic", "rejected_short", "rejected_no_date", "rejected_old", "rejected_judge", "html_saved"]
#: The counters of a whole run, in the order in which they are told.
RUN = ["sources_loaded", "site_results_found", "global_results_found", "found_total", "duplicates_removed", "excluded_urls_removed", "urls_unique", *FUNNEL[4:5], *FUNNEL[10:11], *FUNNEL[5:10], *FUNNEL[3:4], *FUNNEL[2:3]]
SCORER = ["kept", "rejected_structure", "rejected_score", "missing_blob"]
VISIT = ["error", "not_article", "skipped_year", "saved"]
RESULT = ["SKIPPED_ALREADY_SEEN", "OPEN_ERROR", "SEARCH_ENGINE_PAGE_SKIPPED", "SUCCESS", "DOWNLOAD_FAILED", "UNKNOWN_ERROR", "SEARCH_ERROR"]


def html_outcome(on_topic: Column, words: Column, year: Column, interesting: Column) -> Column:
    """First stage that a page fails, cheap stages first; the judge is asked last."""
    return (
        F.when(~F.coalesce(on_topic, F.lit(False)), F.lit("rejected_topic"))
        .when(F.coalesce(words, F.lit(0)) < C.MIN_WORDS_TOPIC, F.lit("rejected_short"))
        .when(year.isNull(), F.lit("rejected_no_date"))
        .when(year < C.MIN_YEAR, F.lit("rejected_old"))
        .when(~F.coalesce(interesting, F.lit(False)), F.lit("rejected_judge"))
        .otherwise(F.lit("html_saved"))
    )


def topic_funnel(rows: DataFrame) -> DataFrame:
    """Outcome of search results with their fetched values (pos, url, code, kind, year, on_topic, words, interesting)."""
    keyed = mark_first(rows.withColumn("url_key", urls.canonical(F.col("url"))).filter("url_key <> ''"), "url_key", "pos", "__gm_one")
    outcome = (
        F.when(urls.excluded(F.col("url_key")), F.lit("excluded"))
        .when(~F.col("__gm_one"), F.lit("duplicate"))
        .when(F.col("code").isNull() | (F.col("code") >= 400), F.lit("download_error"))
        .when(F.col("kind") == "pdf", F.lit("pdf_saved"))
        .when(F.col("kind") != "html", F.lit("other_skipped"))
        .otherwise(html_outcome(F.col("on_topic"), F.col("words"), F.col("year"), F.col("interesting")))
    )
    return keyed.withColumn("outcome", outcome).drop("__gm_one")


def run_counters(sources: DataFrame, results: DataFrame) -> DataFrame:
    """One row with the 16 counters of a run, from the sources and from the outcomes of results with their ``source_type``."""
    n = lambda c: F.count_if(c)
    outcome = F.col("outcome")
    told = results.agg(
        n(F.col("source_type") == "site").alias("site_results_found"),
        n(F.col("source_type") == "global").alias("global_results_found"),
        F.count(F.lit(1)).alias("found_total"),
        n(outcome == "duplicate").alias("duplicates_removed"),
        n(outcome == "excluded").alias("excluded_urls_removed"),
        n(~outcome.isin("duplicate", "excluded")).alias("urls_unique"),
        *[n(outcome == o).alias(o) for o in FUNNEL[2:]],
    )
    return sources.agg(F.count(F.lit(1)).alias("sources_loaded")).join(F.broadcast(told)).select(*RUN)  # two rows are joined


#: Keyword lists longer than this are looked for in one pass over a text.
MANY_KEYWORDS = 64


def score_pages(pages: DataFrame, keywords: list[str], threshold: float = C.MIN_SCORE) -> DataFrame:
    """page_id, score, found, reason, outcome: a page without content first, then structure, then keywords on the visible text."""
    plain = pages.select("page_id", F.col("html").isNull().alias("gone"), classify.reject_reason(F.col("html")).alias("reason"), text.scorer_text(F.col("html")).alias("plain"))
    if len(keywords) > MANY_KEYWORDS:
        scored = automaton.scored(plain, F.col("plain"), keywords, ["page_id", "gone", "reason"])
    else:
        scored = plain.withColumn("score", text.keyword_score(F.col("plain"), keywords)).withColumn("found", text.keywords_found(F.col("plain"), keywords))
    outcome = F.when(F.col("gone"), F.lit("missing_blob")).when(F.col("reason").isNotNull(), F.lit("rejected_structure")).when(F.col("score") < threshold, F.lit("rejected_score")).otherwise(F.lit("kept"))
    return scored.select("page_id", "score", F.array_join("found", ", ").alias("found"), "reason", outcome.alias("outcome"))


def visit_outcome(rows: DataFrame, current_year: int, keep_undated: bool = False) -> DataFrame:
    """Outcome of article visits from (code, news_score, year): only the five denied codes are errors."""
    outcome = (
        F.when(classify.denied_code(F.col("code")), F.lit("error"))
        .when(F.col("news_score") < C.MIN_NEWS_SCORE, F.lit("not_article"))
        .when(~dates.year_kept(F.col("year"), current_year, keep_undated), F.lit("skipped_year"))
        .otherwise(F.lit("saved"))
    )
    return rows.withColumn("outcome", outcome)


def result_status(rows: DataFrame) -> DataFrame:
    """Status of opened results from (known, url, code, kind), and ``failure`` where something else went wrong: search or open."""
    failure = F.col("failure") if "failure" in rows.columns else F.lit(None).cast("string")
    status = (
        F.when(failure == "search", F.lit("SEARCH_ERROR"))
        .when(failure.isNotNull(), F.lit("UNKNOWN_ERROR"))
        .when(F.col("known"), F.lit("SKIPPED_ALREADY_SEEN"))
        .when(F.col("code").isNull(), F.lit("OPEN_ERROR"))
        .when(urls.host(F.col("url")).contains(C.SEARCH_HOST), F.lit("SEARCH_ENGINE_PAGE_SKIPPED"))
        .when(F.col("code") >= 400, F.lit("DOWNLOAD_FAILED"))
        .otherwise(F.lit("SUCCESS"))
    )
    return rows.withColumn("status", status)


def journal_report(articles: DataFrame) -> DataFrame:
    """One row of counts of a journal: visited, saved, skipped_year, errors, and resumed (what a second run leaves alone)."""
    state = F.col("status")
    return articles.agg(
        F.count(F.lit(1)).alias("visited"),
        *[F.count_if(state == s).alias(name) for s, name in (("saved", "saved"), ("skipped_year", "skipped_year"), ("error", "errors"))],
        F.count_if(state.isin(C.DONE_STATES)).alias("resumed"),
    )


def saved_files(articles: DataFrame) -> DataFrame:
    """(url, file) of what a journal says was saved."""
    return articles.filter(F.col("status") == "saved").select("url", "file")


def crawl_summary(outcomes: DataFrame) -> DataFrame:
    """One row: pages saved, ignored and failed, of (outcome)."""
    return outcomes.agg(*[F.count_if(F.col("outcome") == o).alias(name) for o, name in (("saved", "saved"), ("ignored", "ignored"), ("error", "errors"))])


def admitted(rows: DataFrame, known: DataFrame, seed: str) -> DataFrame:
    """Frontier rows that may be fetched: not known, on the seed's host, with an allowed suffix."""
    fresh = rows.join(known.select("url").distinct(), "url", "left_anti")
    return fresh.filter(urls.same_host(F.col("url"), F.lit(seed)) & urls.suffix_allowed(F.col("url")))
