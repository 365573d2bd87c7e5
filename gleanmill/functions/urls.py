"""URL parts, normal forms, names and predicates as native expressions.

Three normal forms live side by side on purpose: ``basic`` for listings,
``seen_key`` for the memory of visited results, ``canonical`` for topic results.
Query values keep their escapes. Null stays null unless stated.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanmill.functions import constants as C


def _lit(text: str) -> Column:
    return F.lit(text)


def any_of(text: Column, parts: list[str]) -> Column:
    """Whether any of the fixed parts occurs in the text."""
    return F.exists(F.array(*map(F.lit, parts)), lambda p: F.contains(text, p))


def scheme(url: Column) -> Column:
    return F.lower(F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*):", 1))


def host_raw(url: Column) -> Column:
    """Authority as written, with port and case."""
    return F.regexp_extract(url, r"^(?:[^:/?#]+:)?//([^/?#]*)", 1)


def host(url: Column) -> Column:
    return F.lower(host_raw(url))


def domain(url: Column) -> Column:
    """Host in lower case without a leading ``www.``."""
    return F.regexp_replace(host(url), r"^www[.]", "")


def path(url: Column) -> Column:
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query(url: Column) -> Column:
    return F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)


def basic(url: Column) -> Column:
    """Cut at the fragment, without slashes at the end."""
    return F.rtrim(F.split_part(url, F.lit("#"), F.lit(1)), F.lit("/"))


def without_dots(path: Column) -> Column:
    """A path from the root without ``.`` and ``..`` segments; ``..`` at the root stays there."""
    parts = F.split(path, "/")
    fold = F.aggregate(
        parts,
        F.array().cast("array<string>"),
        lambda kept, s: F.when(s == "..", F.slice(kept, 1, F.greatest(F.size(kept) - 1, F.lit(0)))).when(s == ".", kept).otherwise(F.array_append(kept, s)),
    )
    whole = F.concat(F.array_join(fold, "/"), F.when(F.element_at(parts, -1).isin(".", "..") & (F.size(fold) > 0), F.lit("/")).otherwise(F.lit("")))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), F.when(F.startswith(whole, F.lit("/")), whole).otherwise(F.concat(F.lit("/"), whole))).otherwise(path)


def resolve(url: Column, base: Column) -> Column:
    """Absolute form of a link against its page; null for templates, blanks and other schemes.

    Covers absolute, scheme-relative, root-relative, query-only and fragment-only
    links and links relative to the page's folder. Dot segments of relative links are
    resolved, those of absolute ones stay; fragments and empty queries go.
    """
    given = F.regexp_replace(F.trim(url), r"#.*$", "")
    link = F.regexp_replace(given, r"^//(?=[/?]|$)", "")  # an empty host is none
    link = F.when(link == "?", F.lit("")).otherwise(link)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_extract(path(base), r"^(.*/)", 1)
    folder = F.when(folder == "", F.lit("/")).otherwise(folder)
    way, rest = F.regexp_extract(link, r"^([^?]*)", 1), F.regexp_extract(link, r"^[^?]*(.*)$", 1)
    near = F.regexp_replace(F.concat(folder, way), r"/{2,}", "/")
    whole = (
        F.when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(given.rlike(r"^//[^/?]"), F.concat(F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1), link))
        .when(link.startswith("/"), F.concat(origin, without_dots(way), rest))
        .when(link == "", F.regexp_replace(base, r"#.*$", ""))
        .when(link.startswith("?"), F.concat(origin, path(base), rest))
        .otherwise(F.concat(origin, without_dots(near), rest))
    )
    whole = F.regexp_replace(whole, r"^([^?]*)\?$", "$1")
    whole = F.concat(scheme(whole), F.regexp_extract(whole, r"^[A-Za-z][A-Za-z0-9+.-]*(:.*)$", 1))
    bad = F.exists(F.array(*map(F.lit, ["{{", "}}", "{%", "%}", " "])), lambda x: F.contains(F.trim(url), x))
    return F.when(~bad & scheme(whole).isin("http", "https"), whole)


def unwrap_redirect(url: Column) -> Column:
    """Target of a search redirect: only on the search host and below ``/l/``."""
    target = F.try_url_decode(F.regexp_extract(url, r"[?&]uddg=([^&#]*)", 1))
    return F.when(is_redirect(url) & (F.coalesce(target, F.lit("")) != ""), F.coalesce(F.try_url_decode(target), target)).otherwise(url)


def unwrap_any_redirect(url: Column) -> Column:
    """Target named by ``uddg`` on any host, else the trimmed URL."""
    link = F.trim(F.coalesce(url, F.lit("")))
    target = F.try_url_decode(F.regexp_extract(link, r"[?&]uddg=([^&#]*)", 1))
    return F.when(F.regexp_like(link, F.lit(r"[?&]uddg=")), F.coalesce(F.try_url_decode(target), target)).otherwise(link)


def _pairs(url: Column) -> Column:
    return F.filter(F.split(query(url), "&"), lambda p: p != "")


def seen_key(url: Column) -> Column:
    """Normal form for the memory of seen URLs: tracking keys are dropped by their beginnings, order is kept."""
    link = unwrap_redirect(F.trim(url))
    lowered = lambda p: F.lower(F.split_part(p, F.lit("="), F.lit(1)))
    kept = F.filter(_pairs(link), lambda p: ~F.exists(F.array(*map(F.lit, C.TRACKING_PREFIXES)), lambda t: F.startswith(lowered(p), t)))
    shown = F.transform(kept, lambda p: F.when(F.contains(p, F.lit("=")), p).otherwise(F.concat(p, F.lit("="))))
    way = F.regexp_replace(F.regexp_replace(path(link), r";[^/]*$", ""), r"(.)/$", "$1")
    way = F.when(way == "", F.lit("/")).otherwise(way)
    start = F.when(scheme(link) == "", F.lit("https")).otherwise(scheme(link))
    tail = F.when(F.size(shown) > 0, F.concat(F.lit("?"), F.array_join(shown, "&"))).otherwise(F.lit(""))
    return F.when(F.coalesce(url, F.lit("")) == "", F.lit("")).otherwise(F.concat(start, F.lit("://"), domain(link), way, tail))


def decoded(part: Column) -> Column:
    """A part of a query as it is meant; escapes that are none stay as written."""
    return F.coalesce(F.try_url_decode(part), F.replace(part, F.lit("+"), F.lit(" ")))


def encoded(part: Column) -> Column:
    """A part of a query with the usual escapes; blanks are plus signs."""
    return F.replace(F.replace(F.url_encode(part), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def canonical(url: Column) -> Column:
    """Normal form for topic results: slashes collapsed, tracking keys dropped whole, pairs sorted by key and value and escaped anew."""
    link = F.trim(F.coalesce(url, F.lit("")))
    way = F.regexp_replace(F.regexp_replace(path(link), r";[^/]*$", ""), r"/{2,}", "/")
    way = F.when(way.isin("", "/"), F.lit("/")).otherwise(F.rtrim(way, F.lit("/")))
    pairs = F.transform(_pairs(link), lambda p: F.struct(decoded(F.split_part(p, F.lit("="), F.lit(1))).alias("k"), decoded(F.regexp_extract(p, "^[^=]*=(.*)$", 1)).alias("v")))
    kept = F.array_sort(F.filter(pairs, lambda p: ~F.lower(p["k"]).isin(C.TRACKING_KEYS)))
    shown = F.transform(kept, lambda p: F.when(p["v"] == "", encoded(p["k"])).otherwise(F.concat(encoded(p["k"]), F.lit("="), encoded(p["v"]))))
    start = F.when(scheme(link) == "", F.lit("https")).otherwise(scheme(link))
    tail = F.when(F.size(shown) > 0, F.concat(F.lit("?"), F.array_join(shown, "&"))).otherwise(F.lit(""))
    return F.when(domain(link) == "", F.lit("")).otherwise(F.concat(start, F.lit("://"), domain(link), way, tail))


def source_form(source: Column) -> Column:
    """A source line as a clean URL: https by default, no ``www.``, query, fragment or slash at the end."""
    text = F.trim(F.coalesce(source, F.lit("")))
    link = F.when(text.startswith("http://") | text.startswith("https://"), text).otherwise(F.concat(F.lit("https://"), text))
    shown = F.concat(scheme(link), F.lit("://"), domain(link), F.rtrim(F.regexp_replace(path(link), r";[^/]*$", ""), F.lit("/")))
    return F.when((text == "") | (domain(link) == ""), F.lit("")).otherwise(shown)


def slug_name(url: Column) -> Column:
    """File name of a saved article: host, path and 40 signs of the query, at most 180 signs."""
    way = F.replace(F.trim(path(url), F.lit("/")), F.lit("/"), F.lit("__"))
    asked = F.left(F.regexp_replace(query(url), r"(?U)[^\w]", "_"), F.lit(40))
    parts = F.filter(F.array(F.replace(host_raw(url), F.lit("www."), F.lit("")), way, asked), lambda p: p != "")
    name = F.regexp_replace(F.regexp_replace(F.array_join(parts, "__"), r"(?U)[^\w\-_.]", "_"), "_+", "_")
    return F.concat(F.left(F.trim(name, F.lit("_")), F.lit(180)), F.lit(".html"))


def topic_name(url: Column, kind: Column) -> Column:
    """File name of a saved topic page: ASCII signs only, ``root`` for an empty path."""
    way = F.trim(path(url), F.lit("/"))
    parts = F.filter(
        F.array(F.replace(host_raw(url), F.lit("www."), F.lit("")), F.when(way == "", F.lit("root")).otherwise(way), F.nullif(query(url), F.lit(""))),
        lambda p: p.isNotNull(),
    )
    name = F.regexp_replace(F.regexp_replace(F.array_join(parts, "_"), "[^a-zA-Z0-9._-]+", "_"), "_+", "_")
    name = F.trim(name, F.lit("._"))
    return F.concat(F.when(name == "", F.lit("document")).otherwise(name), F.when(kind == "pdf", F.lit(".pdf")).otherwise(F.lit(".html")))


def indexed_name(index: Column, suffix: Column) -> Column:
    return F.concat(F.lit("page_"), index.cast("string"), F.when(suffix.startswith("."), suffix).otherwise(F.concat(F.lit("."), suffix)))


def search_url(text: Column) -> Column:
    return F.concat(F.lit(C.SEARCH_URL), F.url_encode(text))


def boolean_query(groups: Column) -> Column:
    """Groups of alternatives as search text: several words are quoted, empty terms and groups left out."""

    def shown(group: Column) -> Column:
        terms = F.transform(F.filter(group, lambda t: F.trim(t) != ""), lambda t: F.when(F.trim(t).contains(" "), F.concat(F.lit('"'), F.trim(t), F.lit('"'))).otherwise(F.trim(t)))
        return F.when(F.size(terms) > 1, F.concat(F.lit("("), F.array_join(terms, " OR "), F.lit(")"))).otherwise(F.array_join(terms, ""))

    return F.array_join(F.filter(F.transform(groups, shown), lambda g: g != ""), " AND ")


def site_query(site: Column, groups: Column) -> Column:
    return F.concat(F.lit("site:"), site, F.lit(" "), boolean_query(groups))


def links(html: Column) -> Column:
    """Array of href values of anchors, trimmed, without mail, script, phone and fragment links."""
    found = F.transform(F.regexp_extract_all(html, F.lit(r"""(?i)<a\s[^>]*?href\s*=\s*["']([^"']*)["']"""), F.lit(1)), lambda x: F.trim(x))
    return F.filter(found, lambda x: (x != "") & ~F.lower(x).rlike("^(mailto:|javascript:|tel:|#)"))


def same_host(url: Column, seed: Column) -> Column:
    return host_raw(url) == seed


def same_domain(url: Column, base: Column) -> Column:
    return domain(url) == F.regexp_replace(F.lower(base), r"^www[.]", "")


def suffix(url: Column) -> Column:
    """Suffix of the last path segment in lower case with its dot, or an empty text."""
    return F.lower(F.regexp_extract(path(url), r"[^/.][^/]*(\.[^./]+)$", 1))


def save_pattern(url: Column) -> Column:
    return any_of(url, C.SAVE_PATTERNS)


def suffix_allowed(url: Column) -> Column:
    return (suffix(url) == "") | suffix(url).isin(C.ALLOWED_SUFFIXES)


def article_candidate(url: Column) -> Column:
    """Neither a denied suffix nor a denied pattern."""
    ends = "(" + "|".join(re.escape(s) for s in C.DENIED_SUFFIXES) + ")$"
    return ~F.lower(path(url)).rlike(ends) & ~url.rlike("(?i)" + "|".join(C.DENIED_PATTERNS))


def article_url(url: Column, pattern: Column | None = None) -> Column:
    """Candidate that also matches the site's pattern, where there is one."""
    if pattern is None:
        return article_candidate(url)
    return article_candidate(url) & F.coalesce(F.regexp_like(url, F.concat(F.lit("(?i)"), pattern)), F.lit(True))


def pagination_url(url: Column, pattern: Column | None = None) -> Column:
    """The site's pagination pattern, or the default ones."""
    default = url.rlike("(?i)" + "|".join(C.PAGINATION_PATTERNS))
    return default if pattern is None else F.coalesce(F.regexp_like(url, F.concat(F.lit("(?i)"), pattern)), default)


def excluded(url: Column) -> Column:
    return any_of(F.lower(url), C.EXCLUDED_PARTS)


def editorial_link(url: Column, base: Column) -> Column:
    """Same host, no navigation part, and a path of three signs or more."""
    return (host_raw(url) == host_raw(base)) & ~any_of(F.lower(path(url)), C.NAVIGATION_PARTS) & (F.char_length(F.trim(path(url), F.lit("/"))) >= 3)


def is_redirect(url: Column) -> Column:
    return F.coalesce(F.contains(host(url), F.lit(C.SEARCH_HOST)) & F.lower(path(url)).startswith("/l/"), F.lit(False))


def route(url: Column, site: Column) -> Column:
    """off_domain, pagination, article or none; pagination is asked before article."""
    return F.when(~same_domain(url, site), F.lit("off_domain")).when(pagination_url(url), F.lit("pagination")).when(article_candidate(url), F.lit("article")).otherwise(F.lit("none"))


def robots_allowed(rules: Column, url: Column) -> Column:
    """Longest matching rule decides; ``rules`` is an array of (prefix, allow); no match allows."""
    hits = F.filter(rules, lambda r: F.startswith(path(url), r["prefix"]))
    best = F.array_max(F.transform(hits, lambda r: F.struct(F.char_length(r["prefix"]).alias("n"), r["allow"].alias("allow"))))
    return F.coalesce(best["allow"], F.lit(True))
