"""Main text of web pages by wrapper induction over pages of the same host.

1. Each page becomes a DOM tree, and that an outline: blocks labelled with tag,
   class and id (digits set to 0), runs of equal neighbours folded into one node.
2. The outlines of all pages of a host, equal ones once, are aligned by simple tree
   matching: a dynamic program over the children, pair by pair of equal labels,
   that maximises the number of matched nodes. Matched nodes are merged, others
   inserted between their siblings: the skeleton of the host. They are merged in
   the order of their digests in ``SALTS`` buckets by digest, then bucket by bucket.
3. Every outline is aligned with the skeleton. Each node counts over all
   different pages how much is said there and how often each text is. Copies count
   as one page: a page is known by its first heading and its three longest texts,
   and of copies the one of least digest counts.
4. What at least ``EVIDENCE`` different pages, and nine tenths of all that have
   the node, say there is template; the rest are slots. The content is what the
   slots say under the smallest block that holds most slot text apart from links.
5. Every page is aligned with its host's wrapper and told without the template.

Tags and names are a prior: they weigh blocks when the content block is
chosen. Within it a block goes if it is named as a list of links or other matter and is mostly
links; if it is named as reader comments, whatever its length, unless nothing else is left or it holds
the main heading; if it is named as an advert, a dialog or the like and has no prose or
less than half of the content; and if it is named by a word that content has too (header, notice, promotion,
social...) only where it has no prose. Prose is a paragraph, a heading or eight words in a
row. Menus, footers, asides and forms by their tag are left out as markup that means so.

Children of two nodes are aligned over the labels that both have. Up to ``CELLS``
pairs the best matching is exact; longer lists are matched along the longest
common order of their labels, the k-th of a label with the k-th, in n log n.

All steps are sums, least hashes or merges in an order that digests fix, so the result does not depend on order or
partitioning. Skeletons and wrappers (some kilobytes a host) are broadcast while
all of them stay below ``BROADCAST_BYTES``, and joined by host and salt beyond.

Defined results: null or empty html, and html without text, give an empty text;
a page whose host cannot be read, and a host with less than ``EVIDENCE`` pages,
have no template, and the page's own texts decide about the block; unfinished
tags at the end of a page are markup; any depth of markup is handled without
recursion; repeated pages and ids are handled row by row; other columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import html as entities
import json
import re
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.llm.arrow_text import slices
from gleanmill.session import ensure_checkpoint_dir, table

BROADCAST_BYTES = 32 << 20
#: Pages of a host whose outlines make its skeleton: all.
REFERENCES = None
EVIDENCE = 3
SALTS = 64
#: Hosts whose skeletons or wrappers a task holds at a time.
HOSTS = 256
SLICE = 1 << 20
#: Outlines that a task knows it has met.
SHAPES = 100_000

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg canvas textarea xmp noembed noframes head title".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q s samp small span strike strong sub sup time tt u var wbr".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dd div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr li main menu nav ol p pre section summary table ul body".split())
SAME = {"li": frozenset(("li",)), "dt": frozenset(("dt", "dd")), "dd": frozenset(("dt", "dd")), "tr": frozenset(("tr", "td", "th")), "td": frozenset(("td", "th")), "th": frozenset(("td", "th")), "option": frozenset(("option",))}
SCOPE = frozenset("ul ol dl table tbody thead select article section main body html div td th".split())
AWAY = frozenset("nav footer aside form menu dialog button select option input label fieldset legend".split())
HOLDS = frozenset("article main".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Names of reader comments, of other matter, and of matter by words that content has too; the last word that says what it is counts.
COMMENTS = frozenset("comment comments commentlist disqus".split())
NAMED = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored cookie cookies consent gdpr popup modal overlay newsletter "
    "subscribe subscription signup login sidebar nav navbar navigation breadcrumb breadcrumbs pagination pager footer topbar toolbar masthead share sharing skip".split()
)
WEAK = frozenset("promo promotion banner notice alert header social widget".split())
PROSE = frozenset("p blockquote pre h1 h2 h3 h4 h5 h6".split())
#: Words in a row that make prose of a text outside paragraphs.
PROSE_WORDS = 8
#: Pairs of children that are compared one by one.
CELLS = 250_000
#: Names that weigh against a block only if it is mostly links.
LISTS = frozenset("side menu toc replies reply respond discussion related recommended recommendations search".split())
_STATES = frozenset("has with no without is not js".split())
_PLACES = frozenset("left right top bottom list box container wrapper wrap area block inner outer section item items bar group panel col column links slot zone".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)(>|\Z)|<[!?][^>]*+(?:>|\Z)|</?\Z", re.S)
_LABELS = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)"


class Node:
    """An element: tag, its class, id and role, and children (elements and texts)."""

    __slots__ = ("tag", "names", "children", "block")

    def __init__(self, tag: str, names: str) -> None:
        self.tag, self.names, self.children, self.block = tag, names, [], tag not in INLINE


def parse(page: str) -> Node:
    """The DOM tree of a page; forgiving about tags that were never opened or closed."""
    root = Node("html", "")
    stack, at = [root], 0
    opened: Counter[str] = Counter()

    def close(depth: int) -> None:
        opened.subtract(n.tag for n in stack[depth:])
        del stack[depth:]

    def close_first(tags: frozenset[str], stop: frozenset[str]) -> None:
        if any(opened[t] > 0 for t in tags):
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in tags:
                    return close(depth)
                if stack[depth].tag in stop:
                    return None
        return None

    for start, end, closing, tag, attributes in _pieces(page):
        if start > at:
            stack[-1].children.append(entities.unescape(page[at:start]))
        at = end
        if not tag or tag == "html":
            continue
        if closing:
            if opened[tag] > 0:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth].tag == tag:
                        close(depth)
                        break
                    if tag in INLINE and stack[depth].tag not in INLINE:
                        break
            continue
        if tag in CLOSES_P:
            close_first(_P, SCOPE)
        if tag in SAME:
            close_first(SAME[tag], _ROWS if tag == "tr" else SCOPE)
        names = " ".join(v.strip("\"'") for _, v in _LABELS.findall(attributes)) if "=" in attributes else ""
        node = Node(tag, names)
        stack[-1].children.append(node)
        if tag not in VOID and not attributes.endswith("/"):
            stack.append(node)
            opened[tag] += 1
    if at < len(page):
        stack[-1].children.append(entities.unescape(page[at:]))
    return root


_P, _ROWS = frozenset(("p",)), SCOPE - {"td", "th"}


def _pieces(page: str) -> Iterator[tuple[int, int, str, str, str]]:
    """(start, end, slash, tag, attributes) of each piece of markup; raw elements are passed as one piece."""
    at = 0
    while m := _TAG.search(page, at):
        tag = (m[2] or "").lower()
        end = m.end()
        if tag in RAW and not m[1] and not (m[3] or "").endswith("/"):
            stop = re.compile(rf"</{tag}\b[^>]*>?", re.I).search(page, end)
            if tag == "head":  # a head that is never closed ends where the body begins
                stop = stop or re.compile(r"(?=<body\b)", re.I).search(page, end)
            yield m.start(), (end := stop.end() if stop else len(page)), "", "", ""
        else:
            yield m.start(), end, m[1] or "", tag, m[3] or ""
        at = end


@functools.lru_cache(4096)
def label_of(tag: str, names: str) -> str:
    """Tag and names, in order, with numbers as 0: what an element is on every page."""
    words = sorted(set(re.sub(r"[0-9]+", "0", names).lower().split()))
    return " ".join([tag, *words])


@functools.lru_cache(4096)
def named(label: str) -> str:
    """What a block's names say: "comment", "named" (advert, sidebar...), "weak" (header, notice...), "list" (menu, related...) or nothing."""
    tag, *names = label.split(" ")
    told = ""
    if tag in INLINE or tag in HEADINGS or tag in ("html", "body", "main", "#"):
        return told
    for name in names:
        words = re.findall(r"[a-z]+", name)
        if not words or words[0] in _STATES:
            continue
        while len(words) > 1 and words[-1] in _PLACES:
            words.pop()
        for kind, some in (("comment", COMMENTS), ("named", NAMED), ("weak", WEAK)):
            if words[-1] in some:
                return kind
        if words[-1] in LISTS:
            told = "list"
    return told


def digest(text: str) -> int:
    """63 bits of a text's hash."""
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "replace"), digest_size=8).digest(), "little") >> 1


class Block:
    """A block of a page: its text if it has no blocks in it, else its blocks; texts between blocks are blocks "#"."""

    __slots__ = ("tag", "label", "children", "text", "links", "gone")

    def __init__(self, tag: str, label: str) -> None:
        self.tag, self.label, self.children, self.text, self.links, self.gone = tag, label, [], "", 0, False


def blocks(root: Node) -> Block:
    """The block tree of a DOM tree."""
    order = [root]
    for node in order:
        order += [c for c in node.children if not isinstance(c, str)]
    for node in reversed(order):
        node.block = node.block or any(not isinstance(c, str) and c.block and c.tag != "br" for c in node.children)
    root.block = True
    top = Block("html", "html")
    todo = [(root, top, False)]
    while todo:
        node, block, linked = todo.pop()
        linked = linked or node.tag == "a"
        run: list[str] = []
        links, whole = 0, all(isinstance(c, str) or not c.block or c.tag in VOID for c in node.children)

        def flush() -> None:
            nonlocal links
            if text := " ".join("".join(run).split()):
                into = block
                if not whole:
                    into = Block("#", "#")
                    block.children.append(into)
                into.text, into.links = text, min(links, len(text))
            run.clear()
            links = 0

        for child in node.children:
            if isinstance(child, str):
                run.append(child)
                links += len(child) * linked
            elif child.tag in VOID:
                if child.block:
                    run.append(" ")
            elif child.block:
                flush()
                part = Block(child.tag, label_of(child.tag, child.names))
                block.children.append(part)
                todo.append((child, part, linked))
            else:
                inline = [(c, linked or child.tag == "a") for c in reversed(child.children)]
                while inline:
                    c, inside = inline.pop()
                    if isinstance(c, str):
                        run.append(c)
                        links += len(c) * inside
                    elif c.tag in VOID:
                        if c.block:
                            run.append(" ")
                    else:
                        inline += [(x, inside or c.tag == "a") for x in reversed(c.children)]
        flush()
    return top


class Out:
    """A node of an outline: label, children and the blocks folded into it."""

    __slots__ = ("label", "children", "members")

    def __init__(self, label: str, members: list[Block]) -> None:
        self.label, self.members, self.children = label, members, []


def fold(root: Block) -> Out:
    """The outline of a block tree: runs of equal neighbours are one node, their children one list."""
    top = Out(root.label, [root])
    todo = [top]
    while todo:
        out = todo.pop()
        merged: list[Out] = []
        for k, member in enumerate(out.members):
            at, last = 0, None
            for child in member.children:
                if last is not None and last.label == child.label:
                    last.members.append(child)
                    continue
                found = next((i for i in range(at, len(merged)) if merged[i].label == child.label), -1) if k else -1
                if found < 0:
                    last = Out(child.label, [child])
                    merged.insert(at, last)
                    at += 1
                else:
                    last, at = merged[found], found + 1
                    last.members.append(child)
        out.children = merged
        todo += merged
    return top


def _labels(tree) -> list[str]:
    return [c.label for c in tree.children]


def _siblings(left: list, right: list, weight: Callable) -> list[tuple]:
    """Children of two matched nodes in order, as (left, right) with None for no partner, matched for the most nodes."""
    first = 0
    while first < min(len(left), len(right)) and left[first].label == right[first].label:
        first += 1
    last = 0
    while last < min(len(left), len(right)) - first and left[-1 - last].label == right[-1 - last].label:
        last += 1
    head = list(zip(left[:first], right[:first], strict=True))
    tail = list(zip(left[len(left) - last :], right[len(right) - last :], strict=True))
    a, b = left[first : len(left) - last], right[first : len(right) - last]
    # What only one of the two has meets nothing.
    both = {x.label for x in a} & {y.label for y in b}
    c, d = [x for x in a if x.label in both], [y for y in b if y.label in both]
    middle = _best(c, d, weight) if len(c) * len(d) <= CELLS else _along(c, d, weight)
    return head + _woven(a, b, middle) + tail


def _woven(a: list, b: list, pairs: list[tuple]) -> list[tuple]:
    """Pairs in order with what stands between them on either side, the left side first."""
    out, i, j = [], 0, 0
    for x, y in [*pairs, (None, None)]:
        while i < len(a) and a[i] is not x:
            out.append((a[i], None))
            i += 1
        while j < len(b) and b[j] is not y:
            out.append((None, b[j]))
            j += 1
        if x is not None:
            out.append((x, y))
            i, j = i + 1, j + 1
    return out


def _along(a: list, b: list, weight: Callable) -> list[tuple]:
    """Pairs of equal labels, the k-th of a label with the k-th, that stand in one order on both sides, of the most weight."""
    places: dict[str, list[int]] = {}
    for j, y in enumerate(b):
        places.setdefault(y.label, []).append(j)
    used: Counter[str] = Counter()
    tree: list[tuple[int, int]] = [(0, -1)] * (len(b) + 1)  # best (weight, last pair) of prefixes
    pairs: list[tuple[int, int, int]] = []  # left, right, pair before
    for i, x in enumerate(a):
        k = used[x.label]
        used[x.label] += 1
        if k >= len(places.get(x.label, ())):
            continue
        j = places[x.label][k]
        best, at = (0, -1), j
        while at:
            best = max(best, tree[at])
            at &= at - 1
        pairs.append((i, j, best[1]))
        found, at = (best[0] + weight(x, b[j]), len(pairs) - 1), j + 1
        while at <= len(b):
            tree[at] = max(tree[at], found)
            at += at & -at
    best, at = (0, -1), len(b)
    while at:
        best = max(best, tree[at])
        at &= at - 1
    out, k = [], best[1]
    while k >= 0:
        i, j, k = pairs[k]
        out.append((a[i], b[j]))
    return out[::-1]


def _best(a: list, b: list, weight: Callable) -> list[tuple]:
    """The matching of the most nodes, by dynamic programming over both lists."""
    if not a or not b:
        return []
    best = [[0] * (len(b) + 1)]
    for x in a:
        row, above = [0], best[-1]
        for j, y in enumerate(b):
            most = max(above[j + 1], row[j])
            row.append(max(most, above[j] + weight(x, y)) if x.label == y.label else most)
        best.append(row)
    out, i, j = [], len(a), len(b)
    while i and j:
        if a[i - 1].label == b[j - 1].label and best[i][j] == best[i - 1][j - 1] + weight(a[i - 1], b[j - 1]):
            i, j = i - 1, j - 1
            out.append((a[i], b[j]))
        elif best[i][j] == best[i][j - 1]:
            j -= 1
        else:
            i -= 1
    return out[::-1]


def alignment(a, b) -> Iterator[tuple]:
    """Simple tree matching of two trees with matching roots: (x, y, their children in order) of all matched nodes.

    Sizes of matchings are taken from the leaves up, over the pairs of equal
    labels that can be reached; equal lists of labels are matched one by one.
    """
    pairs, seen = [(a, b)], {(id(a), id(b))}
    for x, y in pairs:  # grows while it is read
        if _labels(x) == _labels(y):
            new = zip(x.children, y.children, strict=True)
        else:
            by_label: dict[str, list] = {}
            for c in x.children:
                by_label.setdefault(c.label, []).append(c)
            others = Counter(d.label for d in y.children)
            every = sum(len(by_label.get(label, ())) * n for label, n in others.items()) <= CELLS
            nth: Counter[str] = Counter()
            new = []
            for d in y.children:
                some = by_label.get(d.label, ())
                new += [(c, d) for c in (some if every else some[nth[d.label] : nth[d.label] + 1])]
                nth[d.label] += 1
        for c, d in new:
            if c.children and d.children and (id(c), id(d)) not in seen:
                seen.add((id(c), id(d)))
                pairs.append((c, d))
    size: dict[tuple[int, int], int] = {}
    ordered: dict[tuple[int, int], list[tuple]] = {}

    def weight(x, y) -> int:
        return size.get((id(x), id(y)), 1)

    for x, y in reversed(pairs):
        found = ordered[id(x), id(y)] = _siblings(x.children, y.children, weight)
        size[id(x), id(y)] = 1 + sum(weight(c, d) for c, d in found if c is not None and d is not None)
    todo = [(a, b)]
    while todo:
        x, y = todo.pop()
        found = ordered.get((id(x), id(y))) or [(c, None) for c in x.children] + [(None, d) for d in y.children]
        yield x, y, found
        todo += [(c, d) for c, d in found if c is not None and d is not None]


def matched(a, b) -> int:
    """The most nodes that two trees with matching roots share in order."""
    return sum(1 for _ in alignment(a, b))


class Skeleton:
    """A node of a host's skeleton: label, children, candidate or template texts (digest: characters), and slot characters."""

    __slots__ = ("label", "children", "texts", "chars", "links", "index", "weight", "whole", "linked")

    def __init__(self, label: str) -> None:
        self.label, self.children, self.texts, self.chars, self.links, self.index = label, [], {}, 0, 0, 0
        self.weight, self.whole, self.linked = 0.0, 0, 0


def preorder(root) -> list:
    out, todo = [], [root]
    while todo:
        node = todo.pop()
        out.append(node)
        todo += reversed(node.children)
    return out


def copied(out) -> Skeleton:
    """The skeleton of an outline."""
    top = Skeleton(out.label)
    todo = [(out, top)]
    while todo:
        a, b = todo.pop()
        b.children = [Skeleton(c.label) for c in a.children]
        todo += zip(a.children, b.children, strict=True)
    return top


def absorbed(top: Skeleton, tree) -> Skeleton:
    """A skeleton with what it lacks of an outline or another skeleton."""
    for a, _, children in list(alignment(top, tree)):
        a.children = [c if c is not None else copied(d) for c, d in children]
    return top


def merged(pages: list[Out]) -> Skeleton:
    """The skeleton of pages at hand, in the order given, with the texts that two of them have at a node."""
    top = copied(pages[0])
    for page in pages[1:]:
        absorbed(top, page)
    seen: dict[int, Counter] = {}
    for page in pages:
        for a, b, _ in alignment(top, page):
            seen.setdefault(id(a), Counter()).update({(digest(t), len(t)): 1 for t in {m.text for m in b.members if m.text}})
    for node in preorder(top):
        node.texts = {d: n for (d, n), times in sorted(seen.get(id(node), {}).items()) if times > 1}
    return top


def dumped(top: Skeleton) -> str:
    """A skeleton as JSON, flat: (parent, label, texts, chars, links) in preorder."""
    nodes = preorder(top)
    number = {id(n): i for i, n in enumerate(nodes)}
    parent = {id(c): number[id(n)] for n in nodes for c in n.children}
    return json.dumps([[parent.get(id(n), -1), n.label, list(n.texts.items()), n.chars, n.links] for n in nodes], separators=(",", ":"))


def loaded(text: str) -> Skeleton:
    nodes = []
    for i, (parent, label, texts, chars, links) in enumerate(json.loads(text)):
        node = Skeleton(label)
        node.texts, node.chars, node.links, node.index = dict(map(tuple, texts)), chars, links, i
        nodes.append(node)
        if parent >= 0:
            nodes[parent].children.append(node)
    return nodes[0]


def _is_away(label: str) -> bool:
    return label.partition(" ")[0] in AWAY


def identity(page: Out) -> int:
    """A page by its first heading and its three longest texts, so that copies are one page."""
    heading, texts, todo = "", [], [page]
    while todo:
        out = todo.pop()
        if _is_away(out.label) or named(out.label) == "named":
            continue
        said = [m.text for m in out.members if m.text]
        if said and not heading and out.label.partition(" ")[0] in HEADINGS:
            heading = said[0]
        texts += said
        todo += reversed(out.children)
    return digest("\n".join([heading, *sorted(texts, key=lambda t: (-len(t), t))[:3]]))


#: Per node of a skeleton: {page identity: [candidates seen as bits, characters, link characters]}.
Counts = dict[int, dict[int, list[int]]]


def count(top: Skeleton, page: Out, counts: Counts) -> None:
    """Add one page to the counts of a host whose pages are at hand."""
    who = identity(page)
    for a, b, _ in alignment(top, page):
        said = [m for m in b.members if m.text]
        if not said:
            continue
        place = {d: i for i, d in enumerate(a.texts)}
        bits = 0
        for m in said if place else ():
            if (i := place.get(digest(m.text))) is not None:
                bits |= 1 << i
        _add(counts.setdefault(a.index, {}), who, [bits, sum(len(m.text) for m in said), sum(m.links for m in said)])


def _add(node: dict[int, list[int]], who: int, new: list[int]) -> None:
    old = node.get(who)
    node[who] = new if old is None else [old[0] | new[0], max(old[1], new[1]), max(old[2], new[2])]


def wrapper(top: Skeleton, counts: Counts) -> Skeleton:
    """The skeleton with its template texts, and the characters of slots and of links at each node, of pages at hand; ``counted`` does the same for all pages of a table."""
    for node in preorder(top):
        pages = counts.get(node.index, {})
        texts, node.chars, node.links = list(node.texts.items()), 0, 0
        times = [sum(v[0] >> i & 1 for v in pages.values()) for i in range(len(texts))]
        fixed = {i for i, n in enumerate(times) if n >= EVIDENCE and 10 * n >= 9 * len(pages)}
        node.texts = {d: n for i, (d, n) in enumerate(texts) if i in fixed}
        for bits, chars, links in pages.values():
            own = max(0, chars - sum(texts[i][1] for i in fixed if bits >> i & 1))
            node.chars += own
            node.links += min(own, links)
    return top


def alone(page: Out) -> Skeleton:
    """The wrapper of a page without a host: all that it says are slots."""
    top = copied(page)
    for a, b in zip(preorder(top), preorder(page), strict=True):
        a.chars, a.links = sum(len(m.text) for m in b.members), sum(m.links for m in b.members)
    return top


def weigh(top: Skeleton) -> Skeleton:
    """Add up slot characters from the leaves: plain, of links, and weighted by tags and names."""
    nodes = preorder(top)
    holds: set[int] = set()
    for node in reversed(nodes):
        tag = node.label.partition(" ")[0]
        node.whole = node.chars + sum(c.whole for c in node.children)
        node.linked = node.links + sum(c.linked for c in node.children)
        node.weight = max(0, node.chars - node.links) + sum(c.weight for c in node.children)
        if tag in HOLDS or any(id(c) in holds for c in node.children):
            holds.add(id(node))
    told = bool(holds)
    for node in reversed(nodes):
        tag = node.label.partition(" ")[0]
        node.weight = max(0, node.chars - node.links) + sum(c.weight for c in node.children)
        if id(node) in holds:
            node.weight *= 2.0 if tag in HOLDS else 1.0
        elif tag in AWAY or tag == "header":
            node.weight *= 0.02 if tag == "form" else 0.0
        elif (names := named(node.label)) and (names != "list" or 2 * node.linked > node.whole):
            node.weight *= 0.0 if told or names == "comment" else 0.1
    return top


def region(top: Skeleton) -> list[Skeleton]:
    """The way from the root to the smallest block that holds most of the weight.

    A step goes to a child with four fifths of the weight that has blocks itself,
    and stays where it would leave a heading that varies.
    """
    way = [top]
    while True:
        node = way[-1]
        total = max(0, node.chars - node.links) + sum(c.weight for c in node.children)
        pick = max(node.children, key=lambda c: c.weight, default=None)
        if pick is None or not pick.weight or 5 * pick.weight < 4 * total or not pick.children:
            if pick is not None and pick.weight and 5 * pick.weight >= 4 * total and pick.label.partition(" ")[0] in HOLDS:
                way.append(pick)
            return way
        if any(c is not pick and c.weight and c.label.partition(" ")[0] in HEADINGS for c in node.children):
            return way
        way.append(pick)


class Wrapper:
    """A host's wrapper, ready for use."""

    def __init__(self, top: Skeleton) -> None:
        self.top = weigh(top)
        self.way = region(self.top)


def main_text(page: str, host: Wrapper | None = None) -> str:
    """The content of one page under its host's wrapper."""
    own = fold(blocks(parse(page)))
    if host is None or not host.top.weight:
        host = Wrapper(alone(own))
    partner = {id(b): a for a, b, _ in alignment(host.top, own)}
    there = {id(partner[id(o)]): o for o in preorder(own) if id(o) in partner}
    at, reached = own, host.top
    depth = 0
    for depth, step in enumerate(host.way):
        if id(step) not in there:
            # The page has no such block: its own texts decide from here.
            at = _region_of(at)
            break
        at, reached = there[id(step)], step
    inside = depth > 1 or at.label.partition(" ")[0] in HOLDS
    whole = reached.whole
    todo = [at]
    said = None
    while todo:
        out = todo.pop()
        node = partner.get(id(out))
        tag = out.label.partition(" ")[0]
        if out is not at:
            gone = tag in AWAY or (tag == "header" and not inside)
            if not gone and (names := named(out.label)):
                if node is None or not node.whole:
                    said = said or _said(at)
                    chars, links = said[id(out)]
                    of = said[id(at)][0]
                else:
                    chars, links, of = node.whole, node.linked, whole
                gone = 2 * links > chars
                if names == "comment":
                    gone = gone or (chars < of and not _holds(out, _MAIN))
                elif names in ("named", "weak"):
                    gone = gone or not _holds(out, PROSE, PROSE_WORDS) or (names == "named" and 2 * chars < of)
            if gone:
                for m in out.members:
                    m.gone = True
                continue
        if node is not None and node.texts:
            for m in out.members:
                if m.text and digest(m.text) in node.texts:
                    m.gone = True
        todo += out.children
    return _emitted(at)


_MAIN = frozenset(("h1",))


def _holds(out: Out, tags: frozenset[str], words: int = 0) -> bool:
    """Whether a block or one under it has a text of one of the tags that is no link, or one of so many words."""
    for node in preorder(out):
        for m in node.members:
            if m.text and 2 * m.links <= len(m.text) and (m.tag in tags or (words and len(m.text.split(None, words)) >= words)):
                return True
    return False


def _said(top: Out) -> dict[int, tuple[int, int]]:
    """(characters, link characters) under each node of a page's outline."""
    found: dict[int, tuple[int, int]] = {}
    for out in reversed(preorder(top)):
        parts = [(sum(len(m.text) for m in out.members), sum(m.links for m in out.members)), *(found[id(c)] for c in out.children)]
        found[id(out)] = sum(p[0] for p in parts), sum(p[1] for p in parts)
    return found


def _region_of(out: Out) -> Out:
    """The content block under a node of a page, by the page alone."""
    top = weigh(alone(out))
    same = dict(zip(map(id, preorder(top)), preorder(out), strict=True))
    return same[id(region(top)[-1])]


def _emitted(at: Out) -> str:
    """The texts of the blocks that stay, in page order. A heading that is template stays before a text of its section."""
    lines: list[tuple[int, str, bool]] = []
    todo = [(m, 0) for m in reversed(at.members)]
    while todo:
        block, depth = todo.pop()
        if block.gone and not (block.text and block.tag in HEADINGS and block.tag != "h1"):
            continue
        if block.text:
            lines.append((depth, block.text, block.gone))
        todo += [(c, depth + 1) for c in reversed(block.children)]
    out: list[str] = []
    after = -1  # depth of the next text that stays
    for depth, text, held in reversed(lines):
        if held and after < depth:
            continue
        out.append(text)
        after = depth if not held else -1
    return " ".join(reversed(out))


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, int, str]]:
    """(rows, index of a row, html) of every row, a bounded slice of rows at a time."""
    for rows, raw, offsets in slices(batches, "html", SLICE):
        data, at = raw.tobytes(), offsets.tolist()
        for i in range(rows.num_rows):
            yield rows, i, data[at[i] : at[i + 1]].decode("utf-8")


def _small(frame: DataFrame, column: str) -> bool:
    """Whether a frame with a text column may be broadcast, by its measured size."""
    return (frame.agg(F.sum(F.length(column) + 64)).first()[0] or 0) <= BROADCAST_BYTES


def _with_host(rows: DataFrame, known: DataFrame, column: str) -> DataFrame:
    """``rows`` (host, digest, ...) with the host's ``column``; a hot host is spread over salts if both are shuffled."""
    known = known.select(F.col("host").alias("__gm_host"), column)
    if _small(known, column):
        return rows.join(F.broadcast(known), F.col("host") == F.col("__gm_host"), "left").drop("__gm_host")
    known = known.withColumn("__gm_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
    return rows.join(known, (F.col("host") == F.col("__gm_host")) & (F.pmod(F.xxhash64("digest", "page_id"), F.lit(SALTS)) == F.col("__gm_salt")), "left").drop("__gm_host", "__gm_salt")


def outlines(rows: DataFrame) -> DataFrame:
    """(host, who, digest, shape, tree, said) of all ``rows`` (host, digest, html) with a host and a page.

    ``shape`` names the outline, ``tree`` is the outline where a task meets it first;
    ``said`` has the characters, link characters and different texts of each node that says something.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[tuple[str, int]] = set()
        columns: list[list] = [[], [], [], [], [], []]
        for batch, i, page in _pages(batches):
            host, own = batch.column(0)[i].as_py(), fold(blocks(parse(page)))
            tree = dumped(copied(own))
            shape, said = digest(tree), []
            if new := (host, shape) not in met:
                if len(met) >= SHAPES:
                    met.clear()
                met.add((host, shape))
            for k, node in enumerate(preorder(own)):
                if some := [m for m in node.members if m.text]:
                    texts = {digest(t): len(t) for t in {m.text for m in some}}
                    said.append({"node": k, "chars": sum(len(m.text) for m in some), "links": sum(m.links for m in some), "texts": list(texts), "sizes": list(texts.values())})
            for column, value in zip(columns, (host, identity(own), batch.column(1)[i].as_py(), shape, tree if new else None, said), strict=True):
                column.append(value)
            if i == batch.num_rows - 1:
                yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(columns, kinds, strict=True)], names)
                columns = [[], [], [], [], [], []]

    names = ["host", "who", "digest", "shape", "tree", "said"]
    node = pa.struct([("node", pa.int32()), ("chars", pa.int64()), ("links", pa.int64()), ("texts", pa.list_(pa.int64())), ("sizes", pa.list_(pa.int32()))])
    kinds = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(node)]
    schema = "host string, who long, digest long, shape long, tree string, said array<struct<node:int,chars:long,links:long,texts:array<long>,sizes:array<int>>>"
    return rows.filter("host <> '' AND html <> ''").select("host", "digest", "html").mapInArrow(run, schema).checkpoint()


def shapes(told: DataFrame) -> DataFrame:
    """(host, shape, tree): all different outlines of each host of ``told``."""
    return told.filter("tree IS NOT NULL").groupBy("host", "shape").agg(F.first("tree").alias("tree"))


def skeletons(trees: DataFrame) -> DataFrame:
    """(host, skeleton) from all ``trees`` (host, shape, tree)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, top = None, None
        for batch in batches:
            for host, bucket, tree in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                more = loaded(tree.as_py())
                if (host, bucket) == last:
                    absorbed(top, more)
                    continue
                if last is not None:
                    yield _rows(*last, top)
                last, top = (host, bucket), more
        if last is not None:
            yield _rows(*last, top)

    schema = "host string, bucket long, tree string"
    dealt = trees.select("host", F.pmod("shape", F.lit(SALTS)).alias("bucket"), "shape", "tree")
    parts = dealt.repartition("host", "bucket").sortWithinPartitions("host", "bucket", "shape").select("host", "bucket", "tree").mapInArrow(run, schema)
    whole = parts.repartition("host").sortWithinPartitions("host", "bucket").select("host", F.lit(0).cast("long").alias("bucket"), "tree").mapInArrow(run, schema)  # SALTS rows a host
    return whole.select("host", F.col("tree").alias("skeleton"))


def _rows(host: str, bucket: int, top: Skeleton) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([host], pa.string()), pa.array([bucket], pa.int64()), pa.array([dumped(top)], pa.string())], ["host", "bucket", "tree"])


def places(trees: DataFrame, known: DataFrame) -> DataFrame:
    """(host, shape, places): the node of its host's skeleton for each node of an outline, or -1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tops: dict[str, Skeleton] = {}
        for batch in batches:
            found = []
            for host, tree, skeleton in zip(batch.column(0).to_pylist(), batch.column(2), batch.column(3), strict=True):
                if host not in tops:
                    if len(tops) >= HOSTS:
                        tops.clear()
                    tops[host] = loaded(skeleton.as_py())
                own = loaded(tree.as_py())
                at = {b.index: a.index for a, b, _ in alignment(tops[host], own)}
                found.append([at.get(k, -1) for k in range(len(preorder(own)))])
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.list_(pa.int32()))], ["host", "shape", "places"])

    rows = _with_host(trees.withColumns({"digest": F.col("shape"), "page_id": F.col("shape")}), known, "skeleton")
    return rows.select("host", "shape", "tree", "skeleton").mapInArrow(run, "host string, shape long, places array<int>")


def counted(told: DataFrame, at: DataFrame) -> DataFrame:
    """(host, node, texts, sizes, chars, links): template texts, and the characters of slots and of links, of each node by all different pages."""
    once = told.groupBy("host", "who").agg(F.min_by(F.struct("shape", "said"), F.struct("digest", "shape")).alias("p")).select("host", "p.shape", F.explode("p.said").alias("x"))
    spots = at.select(F.col("host").alias("h"), F.col("shape").alias("s"), "places")
    few = at.agg(F.sum(F.size("places") * 4 + 128)).first()[0] or 0
    joined = once.join(F.broadcast(spots) if few <= BROADCAST_BYTES else spots, (F.col("host") == F.col("h")) & (F.col("shape") == F.col("s")))
    said = joined.select("host", F.expr("places[x.node]").alias("node"), "x.chars", "x.links", "x.texts", "x.sizes").filter("node >= 0")
    pages = said.groupBy("host", "node").agg(F.count(F.lit(1)).alias("pages"))
    each = said.select("host", "node", F.explode(F.arrays_zip("texts", "sizes")).alias("t")).groupBy("host", "node", "t").agg(F.count(F.lit(1)).alias("times")).filter(F.col("times") >= EVIDENCE)
    fixed = each.join(pages, ["host", "node"]).filter("10 * times >= 9 * pages").groupBy("host", "node").agg(F.sort_array(F.collect_list("t")).alias("fixed")).checkpoint()
    held = fixed.select(F.col("host").alias("h2"), F.col("node").alias("n2"), "fixed")
    size = fixed.agg(F.sum(F.size("fixed") * 16 + 128)).first()[0] or 0
    both = said.join(F.broadcast(held) if size <= BROADCAST_BYTES else held, (F.col("host") == F.col("h2")) & (F.col("node") == F.col("n2")), "left")
    template = F.expr("coalesce(aggregate(filter(fixed, t -> array_contains(texts, t.texts)), 0L, (sum, t) -> sum + t.sizes), 0L)")
    own = both.select("host", "node", "links", F.greatest(F.lit(0).cast("long"), F.col("chars") - template).alias("own"))
    sums = own.groupBy("host", "node").agg(F.sum("own").alias("chars"), F.sum(F.least("own", "links")).alias("links"))
    return sums.join(held, (F.col("host") == F.col("h2")) & (F.col("node") == F.col("n2")), "left").select("host", "node", F.col("fixed.texts").alias("texts"), F.col("fixed.sizes").alias("sizes"), "chars", "links")


def wrappers(rows: DataFrame) -> DataFrame:
    """(host, wrapper) of every host of ``rows`` (host, digest, page_id, html)."""
    told = outlines(rows)
    trees = shapes(told).checkpoint()
    known = skeletons(trees).checkpoint()
    counts = counted(told, places(trees, known).checkpoint())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for skeleton, nodes in zip(batch.column(1), batch.column(2), strict=True):
                top = loaded(skeleton.as_py())
                every = preorder(top)
                for x in nodes.as_py() or ():
                    node = every[x["node"]]
                    node.texts, node.chars, node.links = dict(zip(x["texts"] or (), x["sizes"] or (), strict=True)), x["chars"], x["links"]
                made.append(dumped(top))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], ["host", "wrapper"])

    nodes = counts.groupBy(F.col("host").alias("h")).agg(F.collect_list(F.struct("node", "texts", "sizes", "chars", "links")).alias("nodes"))  # as many as the skeleton has
    return known.join(nodes, F.col("host") == F.col("h"), "left").select("host", "skeleton", "nodes").mapInArrow(run, "host string, wrapper string")


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text: the main text of every row."""
    ensure_checkpoint_dir(pages.sparkSession)
    html = F.col("html").cast("string")
    rows = pages.select("page_id", "url", html.alias("html"), F.lower(F.coalesce(F.regexp_extract("url", _HOST, 1), F.lit(""))).alias("host"), F.xxhash64(html).alias("digest"))
    joined = _with_host(rows, wrappers(rows).checkpoint(), "wrapper")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, Wrapper | None] = {}
        texts: list[str] = []
        for batch, i, page in _pages(batches):
            host = batch.column(3)[i].as_py()
            if host not in seen:
                if len(seen) >= HOSTS:
                    seen.clear()
                told = batch.column(4)[i]
                seen[host] = Wrapper(loaded(told.as_py())) if told.is_valid else None
            texts.append(main_text(page, seen[host]))
            if i == batch.num_rows - 1:
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string())], ["page_id", "url", "text"])
                texts = []

    kinds = dict(pages.select("page_id", "url").dtypes)
    return joined.select("page_id", "url", "html", "host", "wrapper").mapInArrow(run, f"page_id {kinds['page_id']}, url {kinds['url']}, text string")


def op7_wrapper_induction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
