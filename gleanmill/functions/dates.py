"""Years of publication. A year is an integer; what has none is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanmill.functions import constants as C


def largest_year(text: Column) -> Column:
    """Largest 20yy that stands as a word."""
    return F.array_max(F.transform(F.regexp_extract_all(text, F.lit(C.YEAR), F.lit(1)), lambda x: x.cast("int")))


def first_year(text: Column) -> Column:
    """First 20yy that stands as a word."""
    return F.nullif(F.regexp_extract(text, C.YEAR, 1), F.lit("")).cast("int")


def guarded_year(text: Column, pattern: str = C.DATE_REGEX) -> Column:
    """Year inside the first match of a date pattern."""
    return first_year(F.regexp_extract(text, pattern, 0))


def json_blocks(html: Column) -> Column:
    """Bodies of the JSON-LD scripts."""
    return F.regexp_extract_all(html, F.lit(r"""(?is)<script[^>]*type\s*=\s*["']application/ld\+json["'][^>]*>(.*?)</script>"""), F.lit(1))


def meta(html: Column, attribute: str, name: str) -> Column:
    """Content of the first meta element with this attribute value, null without one."""
    quoted = name.replace(".", "[.]")
    tag = F.regexp_extract(html, rf"""(?is)<meta\s[^>]*{attribute}\s*=\s*["']{quoted}["'][^>]*>""", 0)
    return F.nullif(F.regexp_extract(tag, r"""(?is)content\s*=\s*["']([^"']*)["']""", 1), F.lit(""))


def _json_year(html: Column) -> Column:
    years = F.transform(json_blocks(html), lambda b: F.coalesce(*[first_year(F.get_json_object(b, f"$.{k}")) for k in C.JSON_DATE_KEYS]))
    return F.get(F.filter(years, lambda y: y.isNotNull()), F.lit(0))


def article_year(html: Column, url: Column, text: Column, site_regex: str | None = None, selected: Column | None = None) -> Column:
    """Year of an article; the first place that has one decides.

    The element that the site's selector names (``selected``, its text) by the
    site's pattern or the usual one; without a selector the site's pattern in the
    text; JSON-LD dates, published_time, date metas, time element, URL folder,
    dd/mm/yyyy in the text, any 20yy in the URL.
    """
    if selected is not None:
        steps = [guarded_year(selected, site_regex or C.DATE_REGEX)]
    else:
        steps = [guarded_year(text, site_regex)] if site_regex else []
    steps += [
        _json_year(html),
        first_year(meta(html, "property", "article:published_time")),
        *[first_year(meta(html, "name", n)) for n in C.META_NAMES_LISTING],
        first_year(F.regexp_extract(html, r"""(?is)<time\s[^>]*datetime\s*=\s*["']([^"']*)["']""", 1)),
        F.nullif(F.regexp_extract(url, C.YEAR_FOLDER, 1), F.lit("")).cast("int"),
        guarded_year(text),
        F.nullif(F.regexp_extract(url, C.YEAR_START, 1), F.lit("")).cast("int"),
    ]
    return F.coalesce(*steps)


def topic_year(html: Column, text: Column) -> Column:
    """Year of a topic page: metas in order, time elements, JSON-LD, visible text; the largest year of each place."""
    times = F.transform(
        F.regexp_extract_all(html, F.lit(r"(?is)<time\b[^>]*>.*?</time>"), F.lit(0)),
        lambda t: largest_year(F.concat_ws(" ", F.regexp_extract(t, r"""(?is)datetime\s*=\s*["']([^"']*)["']""", 1), F.regexp_replace(t, r"<[^>]*>", " "))),
    )
    blocks = F.transform(json_blocks(html), largest_year)
    first = lambda a: F.get(F.filter(a, lambda y: y.isNotNull()), F.lit(0))
    return F.coalesce(*[largest_year(meta(html, a, n)) for a, n in C.META_DATES_TOPIC], first(times), first(blocks), largest_year(text))


def chosen_year(search_year: Column, html_year: Column) -> Column:
    return F.coalesce(search_year, html_year)


def recent(year: Column, least: int = C.MIN_YEAR) -> Column:
    return F.coalesce(year >= least, F.lit(False))


def year_kept(year: Column, current: int, keep_undated: bool = False) -> Column:
    """Articles of the current year, and undated ones where that is asked for."""
    return F.coalesce(year == current, F.lit(keep_undated))
