"""SQL fragments for DuckDB that state the same rules as the expressions of the library."""

from __future__ import annotations

import html
import html.entities

from gleanmill.functions import constants as C


def lits(values: list[str]) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


def scheme(u: str) -> str:
    return f"lower(regexp_extract({u}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1))"


def host_raw(u: str) -> str:
    return f"regexp_extract({u}, '^(?:[^:/?#]+:)?//([^/?#]*)', 1)"


def domain(u: str) -> str:
    return f"regexp_replace(lower({host_raw(u)}), '^www[.]', '')"


def path(u: str) -> str:
    return f"regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/?#]*)?([^?#]*)', 1)"


def query(u: str) -> str:
    return f"regexp_extract({u}, '^[^?#]*\\?([^#]*)', 1)"


def suffix(u: str) -> str:
    return f"lower(regexp_extract({path(u)}, '[^/.][^/]*(\\.[^./]+)$', 1))"


def basic(u: str) -> str:
    return f"rtrim(split_part({u}, '#', 1), '/')"


def is_redirect(u: str) -> str:
    return f"coalesce(contains(lower({host_raw(u)}), '{C.SEARCH_HOST}') AND starts_with(lower({path(u)}), '/l/'), false)"


def seen_key(u: str) -> str:
    link = f"CASE WHEN {is_redirect(u)} AND regexp_extract({u}, '[?&]uddg=([^&#]*)', 1) <> '' THEN url_decode(url_decode(regexp_extract({u}, '[?&]uddg=([^&#]*)', 1))) ELSE trim({u}) END"
    kept = f"list_filter(string_split({query('l')}, '&'), lambda p: p <> '' AND NOT list_bool_or(list_transform({lits(C.TRACKING_PREFIXES)}, lambda t: starts_with(lower(split_part(p, '=', 1)), t))))"
    shown = f"list_transform({kept}, lambda p: CASE WHEN contains(p, '=') THEN p ELSE p || '=' END)"
    way = f"regexp_replace(regexp_replace({path('l')}, ';[^/]*$', ''), '(.)/$', '\\1')"
    start = f"CASE WHEN {scheme('l')} = '' THEN 'https' ELSE {scheme('l')} END"
    return (
        f"(SELECT CASE WHEN coalesce(l, '') = '' THEN '' ELSE {start} || '://' || {domain('l')} || CASE WHEN {way} = '' THEN '/' ELSE {way} END || "
        f"CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({shown}, '&') ELSE '' END END FROM (SELECT {link} AS l))"
    )


def _decoded(x: str) -> str:
    return f"url_decode(replace({x}, '+', ' '))"


def _encoded(x: str) -> str:
    return f"replace(url_encode({x}), '%20', '+')"


def canonical(u: str) -> str:
    way = f"regexp_replace(regexp_replace({path('l')}, ';[^/]*$', ''), '/{{2,}}', '/', 'g')"
    pairs = f"list_transform(list_filter(string_split({query('l')}, '&'), lambda p: p <> ''), lambda p: {{'k': {_decoded("split_part(p, '=', 1)")}, 'v': {_decoded("regexp_extract(p, '^[^=]*=(.*)$', 1)")}}})"
    kept = f"list_sort(list_filter({pairs}, lambda p: NOT list_contains({lits(C.TRACKING_KEYS)}, lower(p.k))))"
    shown = f"list_transform({kept}, lambda p: CASE WHEN p.v = '' THEN {_encoded('p.k')} ELSE {_encoded('p.k')} || '=' || {_encoded('p.v')} END)"
    start = f"CASE WHEN {scheme('l')} = '' THEN 'https' ELSE {scheme('l')} END"
    return (
        f"(SELECT CASE WHEN {domain('l')} = '' THEN '' ELSE {start} || '://' || {domain('l')} || CASE WHEN {way} IN ('', '/') THEN '/' ELSE rtrim({way}, '/') END || "
        f"CASE WHEN len({kept}) > 0 THEN '?' || array_to_string({shown}, '&') ELSE '' END END FROM (SELECT trim(coalesce({u}, '')) AS l))"
    )


def any_of(text: str, parts: list[str]) -> str:
    return f"list_bool_or(list_transform({lits(parts)}, lambda p: contains({text}, p)))"


def article_candidate(u: str) -> str:
    ends = "(" + "|".join(s.replace(".", "\\.") for s in C.DENIED_SUFFIXES) + ")$"
    return f"(NOT regexp_matches(lower({path(u)}), '{ends}') AND NOT regexp_matches({u}, '(?i){'|'.join(C.DENIED_PATTERNS)}'))"


def pagination(u: str) -> str:
    return f"regexp_matches({u}, '(?i){'|'.join(C.PAGINATION_PATTERNS)}')"


def squeeze(t: str) -> str:
    return f"trim(regexp_replace({t}, '[\\s\\x0B\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+', ' ', 'g'))"


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_NAMED = "MAP {" + ", ".join(f"{_quoted(n)}: {_quoted(html.unescape(f'&{n};'))}" for n in sorted({*html.entities.name2codepoint, "apos"})) + "}"
_OLD = "MAP {" + ", ".join(f"{n}: {_quoted(html.unescape(f'&#{n};'))}" for n in range(128, 160)) + "}"


def unescape(t: str) -> str:
    name = "regexp_extract(p, '^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});', 1)"
    code = f"CASE WHEN regexp_matches({name}, '^#[xX]') THEN ('0x' || {name}[3:])::BIGINT WHEN starts_with({name}, '#') THEN {name}[2:]::BIGINT END"
    point = f"CASE WHEN {code} = 0 OR {code} > 1114111 OR {code} BETWEEN 55296 AND 57343 THEN chr(65533) ELSE coalesce({_OLD}[({code})::INT], chr(({code})::INT)) END"
    sign = f"CASE WHEN starts_with({name}, '#') THEN {point} ELSE {_NAMED}[{name}] END"
    part = f"CASE WHEN i = 1 THEN p WHEN {name} = '' THEN '&' || p ELSE coalesce({sign}, '&' || {name} || ';') || p[length({name}) + 2:] END"
    return f"array_to_string(list_transform(string_split({t}, '&'), lambda p, i: {part}), '')"


def without(page: str, drop: list[str]) -> str:
    out = f"coalesce({page}, '')"
    for tag in drop:
        out = f"regexp_replace({out}, '(?is)<{tag}\\b.*?</{tag}\\s*>', ' ', 'g')"
    return out


def page_text(page: str, drop: list[str]) -> str:
    out = f"regexp_replace({without(page, drop)}, '(?s)<!--.*?-->', ' ', 'g')"
    return squeeze(unescape(f"regexp_replace({out}, '(?s)<[a-zA-Z/!][^>]*>', ' ', 'g')"))


def blank_count(t: str) -> str:
    return f"CASE WHEN {squeeze(f'coalesce({t}, {chr(39) * 2})')} = '' THEN 0 ELSE len(string_split({squeeze(t)}, ' ')) END"


def word_count(t: str) -> str:
    return f"coalesce(len(regexp_extract_all({t}, '[\\p{{L}}\\p{{M}}\\p{{Nd}}\\p{{Pc}}]+')), 0)"


def paragraphs(page: str) -> str:
    cut = f"regexp_replace({without(page, C.SCORER_TAGS)}, '(?i)<p(?:\\s[^>]*)?>', chr(1), 'g')"
    inner = f"list_transform(string_split({cut}, chr(1))[2:], lambda p: regexp_replace(p, '(?is)</p\\s*>.*$', ''))"
    return f"list_filter(list_transform({inner}, lambda q: {squeeze(unescape(_strip('q')))}), lambda t: t <> '')"


def _strip(t: str) -> str:
    return f"regexp_replace({t}, '(?s)<[a-zA-Z/!][^>]*>', ' ', 'g')"


def occurrences(t: str, k: str) -> str:
    return f"((length({t}) - length(replace({t}, '{k}', ''))) // {len(k)})"


def keyword_score(t: str, keywords: list[str]) -> str:
    total = " + ".join(f"CASE WHEN {occurrences(t, k)} > 0 THEN 1.0::DOUBLE + ln({occurrences(t, k)}::DOUBLE) ELSE 0.0::DOUBLE END" for k in keywords)
    return f"round(least((0.0::DOUBLE + {total}) / {float(len(keywords))}::DOUBLE, 1.0::DOUBLE), 4)"


def keywords_found(t: str, keywords: list[str]) -> str:
    return f"list_filter({lits(keywords)}, lambda k: contains({t}, k))"


def largest_year(t: str) -> str:
    return f"list_max(list_transform(regexp_extract_all({t}, '\\b(20\\d{{2}})\\b', 1), lambda x: x::INT))"


def first_year(t: str) -> str:
    return f"nullif(regexp_extract({t}, '\\b(20\\d{{2}})\\b', 1), '')::INT"


def json_blocks(h: str) -> str:
    return f"regexp_extract_all({h}, '(?is)<script[^>]*type\\s*=\\s*[\"'']application/ld\\+json[\"''][^>]*>(.*?)</script>', 1)"


def meta(h: str, attribute: str, name: str) -> str:
    tag = f"regexp_extract({h}, '(?is)<meta\\s[^>]*{attribute}\\s*=\\s*[\"'']{name.replace('.', '[.]')}[\"''][^>]*>', 0)"
    return f"nullif(regexp_extract({tag}, '(?is)content\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1), '')"


def has_class(h: str, pattern: str) -> str:
    return f"coalesce(list_bool_or(list_transform(regexp_extract_all({h}, '(?is)<[a-z][^>]*\\sclass\\s*=\\s*[\"'']([^\"'']*)[\"'']', 1), lambda v: regexp_matches(v, '(?i){pattern}'))), false)"


def topic_text(page: str) -> str:
    return squeeze(unescape(page_text(page, C.TOPIC_TAGS)))


def suffixes() -> dict[str, str]:
    """Media types and suffixes: the own ones before those of the standard library."""
    import mimetypes

    known = mimetypes.MimeTypes(filenames=())
    return {k: known.guess_extension(k) for k in set(known.types_map[True].values())} | C.MEDIA_SUFFIXES
