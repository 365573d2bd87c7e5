"""Text of pages and documents, word counts, keyword scores and renderings."""

from __future__ import annotations

import functools
import html as standard
import html.entities
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanmill.functions import constants as C


def let(value: Column, body) -> Column:
    """Bind a value once per row: an expression used several times would be evaluated as often."""
    return F.transform(F.array(value), body)[0]


@functools.cache
def references() -> dict[str, str]:
    """Sign of each named reference of HTML 4 and of ``apos``."""
    return {name: chr(code) for name, code in html.entities.name2codepoint.items()} | {"apos": "'"}


@functools.cache
def legacy_codes() -> dict[int, str]:
    """Numbers 128 to 159 as browsers read them."""
    return {code: standard.unescape(f"&#{code};") for code in range(128, 160)}


def _table(entries: dict) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def _sign(name: Column) -> Column:
    """The sign that a reference stands for, null if it is none."""
    hexed = F.lower(F.left(name, F.lit(2))) == "#x"
    code = F.when(hexed, F.conv(F.substring(name, 3, 8), 16, 10)).otherwise(F.substring(name, 2, 8)).cast("long")
    point = let(
        code,
        lambda c: F.when((c == 0) | (c > 0x10FFFF) | c.between(0xD800, 0xDFFF), F.lit("\ufffd")).otherwise(
            F.coalesce(F.try_element_at(_table(legacy_codes()), c.cast("int")), F.decode(F.unhex(F.lpad(F.hex(c), 8, "0")), "UTF-32"))
        ),
    )
    return F.when(name.startswith("#"), point).otherwise(F.try_element_at(_table(references()), name))


def unescape(text: Column) -> Column:
    """Character references that end in a semicolon, named and numbered, as the signs they stand for."""

    def read(part: Column) -> Column:
        name = F.regexp_extract(part, r"^(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});", 1)
        told = lambda n: F.concat(F.coalesce(_sign(n), F.concat(F.lit("&"), n, F.lit(";"))), F.substr(part, F.char_length(n) + 2))
        return let(name, lambda n: F.when(n == "", F.concat(F.lit("&"), part)).otherwise(told(n)))

    return let(text, lambda t: F.when(t.contains("&"), F.array_join(F.transform(F.split(t, "&"), lambda p, i: F.when(i == 0, p).otherwise(read(p))), "")).otherwise(t))


_REFERENCE = re.compile(r"&(#[0-9]{1,7}|#[xX][0-9a-fA-F]{1,6}|[A-Za-z][A-Za-z0-9]{1,31});")


def unescaped(text: str) -> str:
    """The same as ``unescape`` for a text inside a task."""

    def sign(m: re.Match) -> str:
        name = m[1]
        if not name.startswith("#"):
            return references().get(name, m[0])
        code = int(name[2:], 16) if name[1] in "xX" else int(name[1:])
        if code == 0 or code > 0x10FFFF or 0xD800 <= code <= 0xDFFF:
            return "\ufffd"
        return legacy_codes().get(code) or chr(code)

    return _REFERENCE.sub(sign, text) if "&" in text else text


def squeeze(text: Column) -> Column:
    return F.trim(F.regexp_replace(text, r"(?U)\s+", " "))


def without(html: Column, drop: list[str]) -> Column:
    """A page without some elements, in one pass."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), rf"(?is)<({'|'.join(drop)})\b.*?</\1\s*>", " ")


def page_text(html: Column, drop: list[str]) -> Column:
    """Text of a page without the dropped elements, comments and tags, blanks squeezed, references decoded."""
    out = F.regexp_replace(without(html, drop), r"(?s)<!--.*?-->", " ")
    return squeeze(unescape(F.regexp_replace(out, r"(?s)<[a-zA-Z/!][^>]*>", " ")))


def scorer_text(html: Column) -> Column:
    """Lower-case text for the keyword scorer."""
    return F.lower(page_text(html, C.SCORER_TAGS))


def topic_text(html: Column) -> Column:
    """Text for topics; menus and footers stay, case stays; references are decoded once more."""
    return squeeze(unescape(page_text(html, C.TOPIC_TAGS)))


def bytes_text(content: Column) -> Column:
    """UTF-8 if the bytes are that, else Latin-1; lower case."""
    text = content.cast("string")
    return F.lower(F.when(F.is_valid_utf8(text), text).otherwise(F.decode(content, "ISO-8859-1")))


def normalise(text: Column) -> Column:
    return squeeze(F.lower(text))


def safe(text: Column) -> Column:
    """A text without blanks around it, empty for null."""
    return F.trim(F.coalesce(text, F.lit("")))


def word_count(text: Column) -> Column:
    """Runs of letters, digits and underscores in any script."""
    return F.coalesce(F.regexp_count(text, F.lit(r"(?U)\b\w+\b")), F.lit(0))


def blank_count(text: Column) -> Column:
    """Words between blanks; 0 for an empty text."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")
    return let(trimmed, lambda t: F.when(t == "", F.lit(0)).otherwise(F.size(F.split(t, r"(?U)\s+"))))


def occurrences(text: Column, term: Column) -> Column:
    """Occurrences that don't overlap."""
    return ((F.char_length(text) - F.char_length(F.replace(text, term, F.lit("")))) / F.char_length(term)).cast("long")


def keyword_score(text: Column, keywords: list[str]) -> Column:
    """Sum of 1 + ln(occurrences) over the keywords found, by the number of keywords, at most 1, four decimals."""
    if not keywords:
        return F.lit(0.0)
    lowered = F.lower(F.coalesce(text, F.lit("")))
    total = F.lit(0.0)
    for k in keywords:
        n = occurrences(lowered, F.lit(k))
        total = total + F.when(n > 0, 1.0 + F.log(n.cast("double"))).otherwise(F.lit(0.0))
    return F.round(F.least(total / float(len(keywords)), F.lit(1.0)), 4)


def keywords_found(text: Column, keywords: list[str]) -> Column:
    """Keywords that occur, in the order of the list."""
    lowered = F.lower(F.coalesce(text, F.lit("")))
    return F.filter(F.array(*map(F.lit, keywords)).cast("array<string>"), lambda k: F.contains(lowered, k))


def matches_topic(text: Column, groups: list[list[str]]) -> Column:
    """Whether every group has a term in the text; an empty group fails, no groups pass."""
    clean = normalise(F.coalesce(text, F.lit("")))
    ok = F.lit(True)
    for group in groups:
        terms = [" ".join(t.lower().split()) for t in group if t.strip()]
        some = F.lit(False)
        for t in terms:
            some = some | F.contains(clean, F.lit(t))
        ok = ok & some
    return ok


def paragraphs(html: Column) -> Column:
    """Texts of the non-empty paragraphs outside dropped elements; a paragraph ends where the next begins."""
    parts = F.filter(F.split(without(html, C.SCORER_TAGS), r"(?i)<p(?:\s[^>]*)?>"), lambda p, i: i > 0)
    inner = F.transform(parts, lambda p: F.regexp_replace(p, r"(?is)</p\s*>.*$", ""))
    texts = F.transform(inner, lambda p: squeeze(unescape(F.regexp_replace(p, r"(?s)<[a-zA-Z/!][^>]*>", " "))))
    return F.filter(texts, lambda t: t != "")


def mean_paragraph(html: Column) -> Column:
    """Mean number of words of the paragraphs; null without paragraphs."""
    return mean_words(paragraphs(html))


def mean_words(texts: Column) -> Column:
    return let(F.transform(texts, blank_count), lambda c: F.when(F.size(c) > 0, F.aggregate(c, F.lit(0), lambda a, x: a + x) / F.size(c)))


def preview(html: Column, n: int = 5) -> Column:
    return F.slice(paragraphs(html), 1, n)


def title(html: Column) -> Column:
    return squeeze(unescape(F.regexp_extract(F.coalesce(html, F.lit("")), r"(?is)<title[^>]*>(.*?)</title>", 1)))


def markdown(article_title: Column, date: Column, authors: Column, url: Column, description: Column, text: Column) -> Column:
    """An article as Markdown; parts without content are left out."""

    def filled(c: Column) -> Column:
        return F.coalesce(c, F.lit("")) != ""

    labels = C.MARKDOWN
    lines = [
        F.concat(F.lit("# "), F.when(filled(article_title), article_title).otherwise(F.lit(labels["untitled"])), F.lit("\n")),
        F.when(filled(date), F.concat(F.lit(labels["date"]), date)),
        F.when(filled(authors), F.concat(F.lit(labels["authors"]), authors)),
        F.concat(F.lit(labels["source"]), F.coalesce(url, F.lit("")), F.lit("\n")),
        F.when(filled(description), F.concat(F.lit(labels["description"]), description, F.lit("\n"))),
        F.when(filled(text), F.concat(F.lit(labels["text"]), text)),
    ]
    return F.concat_ws("\n", *lines)


def log_block(entry: dict[str, Column]) -> Column:
    """Ten labelled lines and a rule."""
    lines = [F.concat(F.lit(f"{label} : "), F.coalesce(entry[key].cast("string"), F.lit("")) if key in entry else F.lit("")) for label, key in C.LOG_LABELS]
    return F.concat(F.concat_ws("\n", *lines, F.lit("-" * 60)), F.lit("\n"))


def with_base(html: Column, url: Column) -> Column:
    """The page with a base element as first child of its head, unless it has one."""
    tag = F.concat(F.lit('<base href="'), url, F.lit('"/>'))
    head = F.regexp_extract(html, r"(?i)(<head(?:\s[^>]*)?>)", 1)
    at = F.instr(html, head)
    placed = F.concat(F.left(html, at - 1 + F.char_length(head)), tag, F.substr(html, at + F.char_length(head)))
    return F.when(html.rlike(r"(?i)<base[\s>/]"), html).when(head == "", F.concat(tag, html)).otherwise(placed)


def one_line(text: Column) -> Column:
    return F.array_join(F.transform(F.split(F.trim(text), "\r?\n"), lambda x: F.trim(x)), " ")
