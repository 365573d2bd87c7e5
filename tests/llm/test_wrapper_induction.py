import html
import random
import re

from pyspark.sql import functions as F

import pytest
from gleanmill.llm import wrapper_induction as wi
from tests.conftest import DATA


def plain(page):
    """Article text of the generated pages by patterns."""
    m = re.search(r"<article>(.*?)(?:</article>|<footer>|\Z)", page, re.S)
    text = re.sub(r"</?(p|h1|br)\b[^>]*>", " ", re.sub(r"<!--.*?-->", " ", m[1], flags=re.S))
    return " ".join(html.unescape(re.sub(r"<[/a-zA-Z][^>]*(>|\Z)", "", text)).split())


def test_generated_pages(spark):
    pages = {r.page_id: r.html for r in spark.read.parquet(f"{DATA}/pages.parquet").collect()}
    got = {r.page_id: r for r in wi.op7_wrapper_induction(spark, DATA).collect()}
    assert len(got) == len(pages) and all(got[i].text == plain(p) and got[i].n_chars == len(got[i].text) for i, p in pages.items())


def page(i, body, extra=""):
    return f"""<html><head><title>t{i}</title><script>var x = "<p>no</p>";</script></head><body><header>Site head {i}</header><div class="menu"><a href=/a>Home {i}</a></div>
    <div id="page"><div class="story"><h1>Title {i}</h1>{body}<p>Read our terms of use.</p><form>Mail <input></form><aside>More {i}</aside></div>
    <div class="comments"><p>I disagree {i} with all of this in many words</p></div></div>{extra}<div class="cookie-notice">We use cookies {i}</div><footer>Foot {i}</footer>"""


def test_site_without_article_tags(spark, empty):
    rows = [(i, f"https://h.test/{i}", page(i, f"<p>Words of page {i} &amp; <b>bold{i}</b>er<br>next<p>Second &lt;par&gt; {i} about things")) for i in range(12)]
    rows += [(50, "https://h.test/e", None), (51, None, ""), (52, "no url", "plain text only"), (53, "https://other.test/1", page(53, "<p>alone here with words")), (0, "https://h.test/0", rows[0][2]), (60, "https://h.test/cut", page(60, "<p>cut off")[:-40] + "</foo")]
    data = spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, host string, outline string")
    out = wi.extract(data).collect()
    assert len(out) == len(rows)
    got = {r.page_id: r.text for r in out}
    for i in range(12):
        assert got[i] == f"Title {i} Words of page {i} & bold{i}er next Second <par> {i} about things", got[i]
    assert got[50] == "" and got[51] == "" and got[52] == "plain text only" and got[53].startswith("Title 53 alone here with words") and "Foot" not in got[53]
    assert wi.extract(data.limit(0)).count() == 0


def brute_matching(a, b):
    """Simple tree matching by its definition."""
    if a.label != b.label:
        return 0
    best = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + brute_matching(x, y))
    return 1 + best[-1][-1]


def outlined(page):
    return wi.fold(wi.blocks(wi.parse(page)))


def test_tree_matching():
    a, b = outlined("<div><p>x</p><ul><li>1</ul><p>y</p></div>"), outlined("<div><ul><li>2</ul><h2>n</h2><p>y</p></div>")
    assert wi.matched(a, a) == len(wi.preorder(a)) and wi.matched(a, b) == brute_matching(a, b) == 5
    assert [c.label for c in wi.merged([a, b]).children[0].children] == ["p", "ul", "h2", "p"]
    rng = random.Random(5)

    def tree(depth):
        return "".join(f"<{t}>{tree(depth - 1) if depth else 'x'}</{t}>" for t in (rng.choice(("div", "section", "ul")) for _ in range(rng.randint(1, 4))))

    for _ in range(30):
        a, b = outlined(tree(2)), outlined(tree(2))
        assert 0.8 * brute_matching(a, b) <= wi.matched(a, b) <= brute_matching(a, b)


def test_deep_and_broken_markup():
    for bad in ("<", "</", "<!--", "<a href='x", "<script>never closed", "<p>" * 300 + "x", "&#xZZ; &amp &a"):
        wi.main_text(bad)
    for tag in ("div", "b", "section", "li", "blockquote"):
        assert wi.main_text(f"<{tag}>" * 100_000 + "deep words") == "deep words"
        assert wi.main_text(f"<{tag}>" * 50_000 + "deep words" + f"</{tag}>" * 50_000) == "deep words"
        assert wi.loaded(wi.dumped(wi.alone(outlined(f"<{tag}>" * 20_000 + "x")))).label == "html"
    assert wi.main_text("<body>" + "<p>some words</p><h2>head</h2>" * 20_000).count("some words") == 20_000


def test_names_on_wrappers():
    body = """<body class="has-sidebar"><div id="header">Site</div><div class="with-sidebar wrap"><article class="post"><header><h1>T</h1></header><p>Text.</p>
    <div class="share">Share</div><footer>By me</footer></article><article class="comment">No</article></div><div class="sidebar"><p>Side</p></div></body>"""
    assert wi.main_text(body) == "T Text."


def texts(spark, pages):
    data = spark.createDataFrame([(i, f"https://h.test/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    return {r.page_id: r.text for r in wi.extract(data).collect()}


def test_constant_leaves_at_any_depth(spark):
    long = "All rights reserved by the owners of this site. " * 40
    body = "<body><article><h1>T{0}</h1><p>Words of page {0}.</p><div class=box><p>Read our terms.</p><ul><li>One<li>Two {0}</ul></div><div class=legal><div><p>" + long + "</p></div></div></article></body>"
    got = texts(spark, [body.format(i) for i in range(8)])
    assert got == {i: f"T{i} Words of page {i}. Two {i}" for i in range(8)}


def induced(pages):
    """The wrapper of a host from all its pages, without Spark."""
    own = sorted((outlined(p) for p in set(pages)), key=wi.identity)
    top, counts = wi.loaded(wi.dumped(wi.merged(own[: wi.REFERENCES]))), {}
    for p in own:
        wi.count(top, p, counts)
    return wi.Wrapper(wi.loaded(wi.dumped(wi.wrapper(top, counts))))


def test_long_constant_block_does_not_widen_the_region():
    long = "Legal words that never change at all. " * 50
    body = "<body><div class=page><div class=story><h1>T{0}</h1><p>Words of page {0} that are not the same as those of others.</p></div><div class=legal><span>" + long + "</span></div></div></body>"
    assert induced([body.format(i) for i in range(8)]).way[-1].label == "div story"


NEUTRAL = """<body><div class="x1"><div class="q"><a href=/a>Start</a> <a href=/b>Topics of the house</a></div><div class="r7">
<div class="k">{menu}</div><h1>Title {0}</h1><div class="t">Printed by the house of words, all rights stay with it, ask before you copy.</div>
<p>First words of page {0} about things number {1}.</p><div class="w"><p>More words {1} in a box.</p><p>You may write to the house at any time of the day.</p></div>
</div><div class="z"><p>{2}</p></div></div></body>"""


def neutral(n):
    lines = ["Made in town", "Built with care", "House of words"]
    return [NEUTRAL.format(i, i * i + 7, lines[i % 3], menu="Home of good words" + " and more" * 20) for i in range(n)]


def test_alignment_decides_on_neutral_sites(spark):
    pages = neutral(12)
    want = {i: f"Title {i} First words of page {i} about things number {i * i + 7}. More words {i * i + 7} in a box." for i in range(12)}
    assert texts(spark, pages) == want
    assert all(wi.main_text(p) != want[i] and "rights" in wi.main_text(p) for i, p in enumerate(pages))  # without the host the template stays


def test_partitions_and_joins_change_nothing(spark, monkeypatch):
    pages = neutral(100) + neutral(100)
    data = spark.createDataFrame([(i, f"https://h{i % 2}.test/{i}", p) for i, p in enumerate(pages)], "page_id long, url string, html string")
    found = [sorted((r.page_id, r.text) for r in wi.extract(data.repartition(n).orderBy(F.rand(n)) if n else data).collect()) for n in (0, 1, 7)]
    monkeypatch.setattr(wi, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(wi, "HOSTS", 1)
    found.append(sorted((r.page_id, r.text) for r in wi.extract(data).collect()))
    assert found[0][0][1] == "Title 0 First words of page 0 about things number 7. More words 7 in a box."
    assert all(f == found[0] for f in found)


def test_names_are_a_prior_only(spark):
    body = "<body><div class=top><a href=/x>Home</a></div><div class='notice-board'><h1>Board {0}</h1><p>Real body text {0}.</p></div></body>"
    assert texts(spark, [body.format(i) for i in range(6)]) == {i: f"Board {i} Real body text {i}." for i in range(6)}
    body = "<body><div class='story'><h1>T {0}</h1><div class='notice'><p>Nearly all that this page {0} says stands in a block with a bad name.</p></div><p>End {0}.</p><div class='user-comments'><p>I like {0}</p></div></div></body>"
    assert texts(spark, [body.format(i) for i in range(6)])[3] == "T 3 Nearly all that this page 3 says stands in a block with a bad name. End 3."


def test_section_headings_and_few_pages(spark):
    body = "<body><article><h1>T{0}</h1><h2>Abstract</h2><p>Words {0}.</p><h2>Terms</h2><p>Always the same terms.</p></article></body>"
    assert texts(spark, [body.format(i) for i in range(6)]) == {i: f"T{i} Abstract Words {i}." for i in range(6)}
    assert texts(spark, [body.format(i) for i in range(2)])[1] == "T1 Abstract Words 1. Terms Always the same terms."


def test_copies_on_a_host_are_one_page(spark):
    ad = "<body><nav><a href=/{0}>n{0}</a></nav><div class=ad>Buy {0}</div><article><h1>T</h1><p>The same words on every page.</p><p>And more of them.</p></article></body>"
    assert set(texts(spark, [ad.format(i) for i in range(30)]).values()) == {"T The same words on every page. And more of them."}


def test_copies_are_no_template(spark):
    same = "<body><article><h1>T</h1><p>The same words on every page.</p></article></body>"
    assert set(texts(spark, [same] * 8).values()) == {"T The same words on every page."}


def test_names_alone_drop_no_slots(spark):
    body = """<body><article><h1>T{0}</h1><h2 id="related-work">Related {0}</h2><p>Words <span class="share">inline {0}</span></p><section id="discussion"><p>We discuss {0}</p></section>
    <div id="menu-of-the-day">Soup {0}</div><div class="share">Share this</div><div class="related"><a href=/x>Link to page {0}</a></div></article></body>"""
    assert texts(spark, [body.format(i) for i in range(8)]) == {i: f"T{i} Related {i} Words inline {i} We discuss {i} Soup {i}" for i in range(8)}


def test_very_long_pages_and_repeated_rows(spark):
    words = " ".join(f"w{i}" for i in range(200_000))
    page = f"<body><nav><a href=/>menu</a></nav><article><h1>T</h1><p>{words}</p></article></body>"
    data = spark.createDataFrame([(1, "https://h.test/1", page), (1, "https://h.test/1", page), (None, None, page)], "page_id long, url string, html string")
    assert [r.text for r in wi.extract(data).collect()] == ["T " + words] * 3


PROSE = "Real words of the article that stand here for the reader."


@pytest.mark.parametrize("block, stays", [
    ('<div class="header"><h1>Title</h1><p>lead</p></div>', "Title lead"), (f'<div class="promotion"><p>{PROSE}</p></div>', PROSE), (f'<section class="social">{PROSE}</section>', PROSE), (f'<div class="notice"><p>{PROSE}</p></div>', PROSE),
    ('<div class="comments">' + "<div class=c><p>I say what I think of this, and at length.</p></div>" * 60 + "</div>", ""), ('<div id="comments"><p>Only one, but ' + "very " * 400 + "long.</p></div>", ""),
    ('<div class="promo">Buy now</div>', ""), ('<div class="header"><a href=/>Home</a> <a href=/b>News of all</a></div>', ""), ('<div class="share">Share</div>', ""),
])
def test_blocks_of_a_page_alone(block, stays):
    page = f"<body><article><p>First text of the page, in some words.</p>{block}<p>Last text.</p></article></body>"
    assert wi.main_text(page) == " ".join(f"First text of the page, in some words. {stays} Last text.".split())
    longer = page.replace("Last text.", "Last text. " + "And more. " * 500)  # the length of the rest changes nothing
    assert wi.main_text(longer).startswith(" ".join(f"First text of the page, in some words. {stays} Last text.".split()))


def test_a_page_of_comments_alone_keeps_them():
    assert wi.main_text("<body><div class=comments><h1>Guest book</h1><p>Nice.</p></div></body>") == "Guest book Nice."


def test_many_siblings_take_little_time():
    import time

    def page(k, n, label):
        return "<body><article>" + "".join(f'<p id="{label(i, k)}">w{i} {k}</p>' for i in range(n)) + "</article></body>"

    letters = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    for label in (lambda i, k: f"r{letters(i * 7919 + k)}", lambda i, k: f"s{letters(i)}", lambda i, k: f"t{letters((i * 31 + k * (i % 97 == 0)) % 4001)}", lambda i, k: "ab"[(i + k) % 2] * (1 + i % 3)):
        began = time.time()
        a, b = outlined(page(0, 20_000, label)), outlined(page(1, 19_000, label))
        assert wi.matched(a, b) >= 3 and time.time() - began < 20


def test_long_lists_are_matched_in_one_order(monkeypatch):
    import random

    r = random.Random(6)
    monkeypatch.setattr(wi, "CELLS", 0)
    for _ in range(30):
        names = [f"n{chr(97 + i)}" for i in range(20)]
        left, right = (r.sample(names, r.randint(5, 20)) for _ in (0, 1))
        trees = [outlined("<body>" + "".join(f'<div class="{n}"><p>{n}</p></div>' for n in part) + "</body>") for part in (left, right)]
        pairs = [(x.label, y.label) for _, _, found in wi.alignment(*trees) for x, y in found if x is not None and y is not None and x.label.startswith("div")]
        assert all(x == y for x, y in pairs)
        best = [[0] * (len(right) + 1)]
        for x in left:
            row = [0]
            for j, y in enumerate(right):
                row.append(max(row[j], best[-1][j + 1], best[-1][j] + (x == y)))
            best.append(row)
        assert len(pairs) == best[-1][-1]


def test_blocks_of_few_pages_are_in_the_skeleton(spark):
    """Template that three pages of sixty have is found, and its node is counted over all pages, not over some of least hash."""
    rare = '<div class="r7"><div class="v">Printed on grey paper by the house of words.</div><span>No {0}</span><p>Words of page {0} alone.</p></div>'
    pages = [f"<body><div class=x1><h1>Title {i}</h1>" + (rare.format(i) if i % 20 == 7 else f"<p>First words of page {i}.</p><p>Second {i}.</p>") + "</div></body>" for i in range(60)]
    got = texts(spark, pages)
    assert {i: got[i] for i in (7, 27, 47)} == {i: f"Title {i} No {i} Words of page {i} alone." for i in (7, 27, 47)}
    # 200 pages say a line at a node, 30 say others: under nine tenths of all, whatever the hashes are.
    pages = [f"<body><article><h1>T{i}</h1><p>Words {i}.</p><blockquote>{'Always said.' if i >= 30 else f'Other {i}.'}</blockquote></article></body>" for i in range(230)]
    assert texts(spark, pages)[200] == "T200 Words 200. Always said."


def test_counts_of_a_table_are_those_of_plain_loops(spark):
    pages = neutral(40) + [p.replace("First words", "Other words") for p in neutral(9)]
    data = spark.createDataFrame([(i, "h", i, p) for i, p in enumerate(pages)], "page_id long, host string, digest long, html string")
    made = wi.loaded(wi.wrappers(data).first().wrapper)
    own = [outlined(p) for p in pages]
    top, counts = wi.loaded(wi.dumped(wi.merged(own))), {}
    for p in own:
        wi.count(top, p, counts)
    plainly = wi.wrapper(top, counts)
    told = lambda top: sorted((n.label, sorted(n.texts.items()), n.chars, n.links) for n in wi.preorder(top))
    assert told(made) == told(plainly)
