"""Small fixed tables as SQL that Spark and DuckDB read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RESULTS = """SELECT * FROM (VALUES
  (1, 'q1', 'https://www.Example.org/a/?utm_source=x&b=2&a=1#f', 1), (2, 'q1', 'https://example.org/a?b=2&a=1', 1),
  (3, 'q1', 'https://duckduckgo.com/l/?uddg=https%3A%2F%2Fsite.test%2Fnews%2F', 1), (4, 'q1', 'https://site.test/news', 2),
  (5, 'q2', 'https://site.test/tag/x', 1), (6, 'q2', 'https://site.test/tag/x', 1), (7, 'q2', 'https://a.test//b///c/', 2),
  (8, 'q2', 'https://a.test/b/c', 2), (9, 'q3', 'example.org/x', 3), (10, 'q3', '', 3), (11, 'q3', 'https://a.test/?k=&ref=z', 3),
  (12, 'q3', 'https://a.test/?k', 3), (13, 'q3', 'HTTP://B.test:8080/P;v=1/q;x?z=1&Y=2&y=1', 3), (14, 'q3', 'https://duckduckgo.com/about', 3),
  (15, 'q3', 'https://c.test/x?GCLID=1&fbclid_a=2&ok=3', 3), (16, 'q1', 'https://other.test/l/?uddg=https%3A%2F%2Fd.test%2F', 4), (17, 'q1', NULL, 4)
) AS t(pos, query, url, prio)"""

LINKS = """SELECT * FROM (VALUES
  (1, 'https://h.test/a/b', '/x'), (2, 'https://h.test/a/b', 'c'), (3, 'https://h.test/a/', 'c?x=1'), (4, 'https://h.test/a/b?q=1', '?p=2'),
  (5, 'https://h.test/a/b?q=1', '#top'), (6, 'https://h.test/a/b', '//o.test/z#f'), (7, 'https://h.test/a/b', 'mailto:x@y.z'),
  (8, 'https://h.test/a/b', 'https://o.test/a b'), (9, 'https://h.test/a/b', 'https://o.test/{{v}}'), (10, 'https://h.test', 'n'),
  (11, 'https://h.test/a/b', '  https://o.test/k#z  '), (12, 'https://h.test/a/b', 'ftp://o.test/k'), (13, 'https://h.test/a/b', '')
) AS t(id, base, link)"""

NAMES = """SELECT * FROM (VALUES
  (1, 'https://www.site.test/a/b/c.html?x=1&y=2', 'html', 'text/html; charset=utf-8'), (2, 'https://site.test/', 'pdf', 'application/pdf'),
  (3, 'https://site.test/abs/2401.12345', 'html', ''), (4, 'https://site.test/f.PDF', 'pdf', 'application/x-unknown'),
  (5, 'https://site.test/f.docx', 'html', 'application/vnd.openxmlformats-officedocument.wordprocessingml.document'),
  (6, 'https://site.test/f.doc', 'html', NULL), (7, 'https://site.test/f.txt', 'html', 'text/plain'), (8, 'https://site.test/x.longsuffix', 'html', 'application/x-none'),
  (9, 'https://site.test/été/ü', 'html', 'image/png'), (10, 'https://site.test/--a--//b', 'html', 'x/y'), (11, 'https://site.test/about/us.html', 'html', 'application/json'),
  (12, 'https://site.test/page/3/', 'html', 'text/xml'), (13, 'https://site.test/login?s=1', 'html', ' IMAGE/GIF ;x')
) AS t(id, url, kind, content_type)"""

DATES = """SELECT * FROM (VALUES
  (1, 'https://s.test/a', '<html><script type="application/ld+json">{"@type": "NewsArticle", "datePublished": "2024-03-01"}</script><p>2026</p>', 2023),
  (2, 'https://s.test/a', '<meta property="article:published_time" content="2025-01-02"><time datetime="2021-01-01">x</time>', NULL),
  (3, 'https://s.test/a', '<meta name="pubdate" content="2022"><meta name="date" content="none">', NULL),
  (4, 'https://s.test/a', '<time class="d" datetime="2020-05-05">5 May 2019</time>', NULL), (5, 'https://s.test/2026/x', '<p>no date</p>', NULL),
  (6, 'https://s.test/a', '<p>le 03/02/2025 et 04/05/2027</p>', NULL), (7, 'https://s.test/titre-2026a1', '<p>none</p>', NULL), (8, 'https://s.test/a', '<p>20300 1999</p>', NULL),
  (9, 'https://s.test/a', '<article><div class="byline">A</div><p>2018 2031</p></article>', 2025), (10, 'https://s.test/a', '<meta property="og:type" content="Article"><meta name="author" content="x">', NULL),
  (11, 'https://s.test/a', '<div class="post-content date">x</div><a rel="author">y</a>', NULL), (12, 'https://s.test/a', '', NULL),
  (13, 'https://s.test/a', '<html><body>Just a moment...</body></html>', NULL), (14, 'https://s.test/a', '<p>Please solve the CAPTCHA</p>', NULL),
  (15, 'https://s.test/a', '<p>Log in to continue</p>', NULL), (16, 'https://s.test/a', '<p>We use <b>cookies</b></p>', NULL),
  (17, 'https://s.test/a', '<script type="application/ld+json">{"@type": ["Thing", "BlogPosting"], "dateModified": "2017"}</script>', NULL)
) AS t(id, url, html, search_year)"""

ANSWERS = """SELECT * FROM (VALUES
  (1, '{"interessant": true}'), (2, 'Voici: {"interessant": false} fin'), (3, '{"interessant": "false"}'), (4, '{"autre": true}'), (5, 'rien'), (6, '{"interessant": 0}'),
  (7, '{"interessant": 2}'), (8, '{"interessant": null}'), (9, '{"interessant": ""}'), (10, ''), (11, NULL), (12, '{broken {"interessant": true}}')
) AS t(id, answer)"""

TOPICS = """SELECT * FROM (VALUES
  (1, 'Crisis in IRAN and the usa'), (2, 'iran crisis'), (3, 'israel   crisis' ), (4, 'Iran, Israel: crisis'), (5, ''), (6, NULL)
) AS t(id, txt)"""

STATE = """SELECT * FROM (VALUES
  ('u1', 'https://a.test/1', 'a.test', 0.7, 3), ('u2', 'https://a.test/2', 'a.test', NULL, 1), ('u3', 'https://b.test/1', 'b.test', NULL, 2), ('u4', 'https://b.test/2', 'b.test', 0.9, 4)
) AS t(uuid, url, domaine, score, crawled)"""

FAILED = "SELECT * FROM (VALUES ('https://c.test/9', 'c.test'), ('https://b.test/3', 'b.test')) AS t(url, domaine)"

FRONTIER = """SELECT * FROM (VALUES
  ('https://a.test/1'), ('https://a.test/2'), ('https://b.test/3'), ('https://c.test/9'), ('https://d.test/1')
) AS t(url)"""

VISITS = """SELECT * FROM (VALUES
  (1, 's1', 'r', 'html', true), (2, 's1', 'r', 'html', false), (3, 's1', 'r', 'html', true), (4, 's1', 'q', 'pdf', true), (5, 's1', 'q', 'pdf', true), (6, 's1', 'r', 'html', true),
  (7, 's2', 'q', 'html', false), (8, 's2', 'r', 'html', true), (9, 's2', 'q', 'pdf', true), (10, 's3', 'z', 'html', false)
) AS t(pos, site, stem, kind, saved)"""

FETCHES = """SELECT * FROM (VALUES
  (1, 'https://a.test/1', 200, 'html', 2025, true, 500, true, false), (2, 'https://a.test/2', 404, 'html', 2025, true, 500, true, false), (3, 'https://a.test/3', 500, 'html', 2025, true, 500, true, false),
  (4, 'https://a.test/tag/4', 200, 'html', 2025, true, 500, true, false), (5, 'https://a.test/5', 200, 'pdf', NULL, false, 0, false, false), (6, 'https://a.test/6', 200, 'html', NULL, true, 500, true, false),
  (7, 'https://a.test/7', 200, 'html', 2019, true, 500, true, false), (8, 'https://a.test/8', 200, 'html', 2026, false, 500, true, false), (9, 'https://a.test/9', 200, 'html', 2026, true, 20, true, false),
  (10, 'https://a.test/10', 200, 'html', 2026, true, 500, false, false), (11, 'https://a.test/11', 200, 'other', 2026, true, 500, true, false), (12, 'https://a.test/1', 200, 'html', 2025, true, 500, true, false),
  (13, 'https://duckduckgo.com/x', 200, 'html', 2025, true, 500, true, false), (14, 'https://a.test/14', NULL, 'html', 2025, true, 500, true, false), (15, 'https://a.test/15', 200, 'html', 2026, true, 500, true, true)
) AS t(pos, url, code, kind, year, on_topic, words, interesting, known)"""

DIRECTORY = """SELECT * FROM (VALUES
  (1, 'Lyon', 'Dupont', '01 02', 'a@x.test'), (2, 'Lyon', 'Dupont', '03 04', NULL), (3, 'Paris', 'Martin', NULL, NULL)
) AS t(pos, place, name, tel, mail)"""
PEOPLE = "SELECT * FROM (VALUES ('Lyon', 'Dupont'), ('Paris', 'Martin'), ('Nice', 'Durand')) AS t(place, name)"

ROBOTS = "SELECT * FROM (VALUES ('h.test', '/', true), ('h.test', '/private', false), ('h.test', '/private/open', true)) AS t(host, prefix, allow)"
ASKED = "SELECT * FROM (VALUES ('https://h.test/a'), ('https://h.test/private/x'), ('https://h.test/private/open/y'), ('https://o.test/private')) AS t(url)"


def fixture(spark: SparkSession, sql: str) -> DataFrame:
    return spark.sql(sql)
