"""Classes of pages, files and answers."""

from __future__ import annotations

import functools
import mimetypes

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanmill.functions import constants as C
from gleanmill.functions import dates, text, urls


def reject_reason(html: Column, kind: Column | None = None) -> Column:
    """Why a page is no article, null if it is one; files that are not HTML always are."""
    short, thin = C.REASON_SHORT, C.REASON_THIN
    reason = text.let(
        text.blank_count(text.page_text(html, C.SCORER_TAGS)),
        lambda words: F.when(words < C.MIN_WORDS_PAGE, F.concat(F.lit(short[0]), words.cast("string"), F.lit(short[1].format(C.MIN_WORDS_PAGE)))).when(text.mean_paragraph(html) < C.MIN_WORDS_PARAGRAPH, F.lit(thin)),
    )
    return reason if kind is None else F.when(kind == "html", reason)


def _class(html: Column, pattern: str) -> Column:
    values = F.regexp_extract_all(html, F.lit(r"""(?is)<[a-z][^>]*\sclass\s*=\s*["']([^"']*)["']"""), F.lit(1))
    return F.exists(values, lambda v: v.rlike("(?i)" + pattern))


def news_score(html: Column) -> Column:
    """Points for signs of a news page."""
    types = F.transform(dates.json_blocks(html), lambda b: F.coalesce(F.get_json_object(b, "$['@type']"), F.lit("")))
    hits = F.size(F.filter(types, lambda t: F.exists(F.array(*map(F.lit, C.ARTICLE_TYPES)), lambda a: F.contains(t, a))))
    on = lambda c, n: F.when(F.coalesce(c, F.lit(False)), F.lit(n)).otherwise(F.lit(0))
    return (
        hits * 4
        + on(F.lower(dates.meta(html, "property", "og:type")).contains("article"), 3)
        + on(html.rlike(r"(?i)<article[\s>]"), 2)
        + on(html.rlike(r"(?i)<time[\s>]") | _class(html, C.DATE_CLASS), 2)
        + on(html.rlike(r"""(?is)<[a-z][^>]*\srel\s*=\s*["'][^"']*\bauthor\b""") | _class(html, C.AUTHOR_CLASS), 1)
        + on(html.rlike(r"""(?is)<meta\s[^>]*name\s*=\s*["']author["']"""), 1)
        + on(_class(html, C.BODY_CLASS), 2)
    )


def is_news(html: Column, url: Column, pattern: Column | None = None) -> Column:
    """The site's pattern alone where there is one, else three points or more."""
    scored = news_score(html) >= C.MIN_NEWS_SCORE
    return scored if pattern is None else F.coalesce(F.regexp_like(url, F.concat(F.lit("(?i)"), pattern)), scored)


def is_block(html: Column) -> Column:
    return urls.any_of(F.lower(F.coalesce(html, F.lit(""))), C.BLOCK_SIGNS)


def is_captcha(html: Column) -> Column:
    return urls.any_of(F.lower(F.coalesce(html, F.lit(""))), C.CAPTCHA_SIGNS)


def is_login_wall(html: Column) -> Column:
    return urls.any_of(F.lower(F.coalesce(html, F.lit(""))), C.LOGIN_SIGNS)


def is_consent(html: Column) -> Column:
    plain = F.lower(F.regexp_replace(F.coalesce(html, F.lit("")), r"(?s)<[a-zA-Z/!][^>]*>", ""))
    return urls.any_of(plain, C.CONSENT_SIGNS)


def obstacle(html: Column) -> Column:
    """block, captcha, login or consent for a page that stands in the way, else null."""
    return F.when(is_block(html), F.lit("block")).when(is_captcha(html), F.lit("captcha")).when(is_login_wall(html), F.lit("login")).when(is_consent(html), F.lit("consent"))


def is_listing(n_links: Column) -> Column:
    return n_links >= C.MIN_LISTING_LINKS


def file_kind(url: Column, content_type: Column) -> Column:
    """pdf, docx, doc, txt or html by suffix, then by content type."""
    way, kind = F.lower(urls.path(url)), F.coalesce(content_type, F.lit(""))
    return (
        F.when(way.endswith(".pdf") | kind.contains("pdf"), F.lit("pdf"))
        .when(way.endswith(".docx") | kind.contains("docx"), F.lit("docx"))
        .when(way.endswith(".doc"), F.lit("doc"))
        .when(way.endswith(".txt") | kind.contains("text/plain"), F.lit("txt"))
        .otherwise(F.lit("html"))
    )


def content_kind(url: Column, content_type: Column, content: Column) -> Column:
    """pdf, html or other by header, suffix, then the first bytes."""
    kind, way = F.lower(F.coalesce(content_type, F.lit(""))), F.lower(urls.path(url))
    start = F.lower(F.decode(F.substring(content, 1, 800), "ISO-8859-1"))
    return (
        F.when(kind.contains("application/pdf") | way.endswith(".pdf"), F.lit("pdf"))
        .when(kind.contains("text/html") | kind.contains("application/xhtml"), F.lit("html"))
        .when(F.startswith(content, F.lit(b"%PDF")), F.lit("pdf"))
        .when(start.contains("<html") | start.contains("<!doctype html"), F.lit("html"))
        .otherwise(F.lit("other"))
    )


@functools.cache
def standard_suffixes() -> dict[str, str]:
    """The usual suffix of every media type that the standard library knows, whatever files the machine has."""
    known = mimetypes.MimeTypes(filenames=())
    return {kind: found for kind in sorted(set(known.types_map[True].values())) if (found := known.guess_extension(kind))}


def guess_suffix(content_type: Column, url: Column) -> Column:
    """File suffix of a media type, by the own table and then by the standard one, else that of the URL if short, else ``.bin``."""
    kind = F.lower(F.trim(F.split_part(F.coalesce(content_type, F.lit("")), F.lit(";"), F.lit(1))))
    table = F.create_map(*[F.lit(x) for pair in (standard_suffixes() | C.MEDIA_SUFFIXES).items() for x in pair])
    own = urls.suffix(url)
    return F.coalesce(F.try_element_at(table, kind), F.when((own != "") & (F.char_length(own) <= 8), own), F.lit(".bin"))


def answer_flag(answer: Column, key: str = "interessant") -> Column:
    """Truth of a key in a JSON answer, whole or wrapped in prose; null where there is none.

    Any value counts by its truth: the text "false" is true, false, null, 0 and
    empty values are not.
    """

    def read(part: Column) -> Column:
        value = F.try_variant_get(F.try_parse_json(part), f"$.{key}", "string")
        has = F.try_variant_get(F.try_parse_json(part), f"$.{key}", "variant")
        kind = F.schema_of_variant(has)
        falsy = ((kind == "BOOLEAN") & (value == "false")) | (kind == "VOID") | ((kind == "STRING") & (value == "")) | (kind.isin("BIGINT", "DOUBLE") & (value.try_cast("double") == 0)) | kind.startswith("DECIMAL") & (value.try_cast("double") == 0) | value.isin("[]", "{}")
        return F.when(has.isNotNull(), ~F.coalesce(falsy, F.lit(False)))

    return F.coalesce(read(F.trim(answer)), read(F.regexp_extract(answer, r"(?s)\{.*?\}", 0)))


def denied_code(code: Column) -> Column:
    return F.coalesce(code.isin(C.DENIED_CODES), F.lit(False))


def size_allowed(content: Column, most: int = C.MAX_FILE_BYTES) -> Column:
    """Whether a body is small enough to be kept; none at all is."""
    return F.coalesce(F.length(content) <= most, F.lit(True))


def non_empty_article(title: Column, body: Column) -> Column:
    """Whether an article has a title or a text."""
    return (F.coalesce(title, F.lit("")) != "") | (F.coalesce(body, F.lit("")) != "")
