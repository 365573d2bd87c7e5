import collections
import gc
import random
import re
import sys
import weakref

import numpy as np
import pyarrow as pa
import pytest

from gleanmill.llm import frames, ngram_join
from gleanmill.llm.components import components
from gleanmill.session import ensure_checkpoint_dir
from tests.llm.conftest import rows


def shingles(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())


def brute(docs):
    sets = [(d, shingles(t)) for d, t in docs]
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, (_, a) in enumerate(sets):
        for j in range(i):
            b = sets[j][1]
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    smallest = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            smallest[find(i)] = min(smallest.get(find(i), d), d)
    return collections.Counter((d, len(s), smallest.get(find(i), d)) for i, (d, s) in enumerate(sets))


def made(seed):
    """Families of near copies at all distances, a passage that most texts share, short texts and copies."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(2, 4)))
    passage = [word() for _ in range(30)]
    docs = []
    for family in range(12):
        base = [word() for _ in range(rng.choice((3, 5, 6, 9, 20, 60, 120)))]
        if family % 3:
            base = base + passage
        for _ in range(rng.choice((1, 2, 8, 30))):
            copy = list(base)
            for _ in range(rng.choice((0, 0, 1, 1, 2, 4))):
                copy[rng.randrange(len(copy))] = word()
            docs.append(" ".join(copy[: len(copy) - rng.choice((0, 0, 1, 3))]))
    docs += [" ".join(passage), "", None, "a", "a", "A"]
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_DOCS", 8)
    monkeypatch.setattr(ngram_join, "CHUNK", 4)
    monkeypatch.setattr(ngram_join, "PART", 3)
    monkeypatch.setattr(ngram_join, "CROWD", 5)
    docs = made(seed)
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(spark.createDataFrame(docs, "doc_id long, text string").repartition(3)).collect())
    assert got == brute(docs)


def test_shuffled_ids_instead_of_broadcast(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    docs = made(3)[:60]
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(spark.createDataFrame(docs, "doc_id long, text string")).collect())
    assert got == brute(docs)


def licence(n):
    """Documents of four words of their own and a line of 24 words that all share."""
    line = " ".join(f"licence{i}" for i in range(24))
    return [(i, f"w{i}a w{i}b w{i}c w{i}d {line}") for i in range(n)]


def steps(spark, docs):
    """The stages of the join up to the parts that qualify."""
    ensure_checkpoint_dir(spark)
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    _, reps, common = ngram_join.classes(frame)
    members = ngram_join.listed(frame, common)
    known = reps.join(members.select("node").distinct(), "node", "left_semi").checkpoint()
    _, grouped = ngram_join.groups(frame, members, known)
    queries = ngram_join.asked(members, grouped)
    return queries, ngram_join.qualified(queries, members, grouped)


@pytest.mark.parametrize("more", [[], [(-1, "licence line")]])
def test_shared_line_asks_no_pairs(spark, monkeypatch, more):
    monkeypatch.setattr(ngram_join, "HOT_DOCS", 20)
    line = " ".join(f"licence{i}" for i in range(24))
    # The line alone and with one or two more words: groups of their own that all the others meet.
    short = [(10**6, line), (10**6 + 1, line + " end"), (10**6 + 2, line + " one two")] if more else []
    counts = {}
    for n in (200, 400):
        queries, found = steps(spark, licence(n) + short)
        counts[n] = queries.count(), found.count()
    assert counts[400][0] <= 2 * counts[200][0] + 10 and counts[400][0] <= 4 * 400
    assert counts[400][1] <= 2 * counts[200][1] + 10


def test_prints_never_say_too_little():
    rng = np.random.default_rng(3)

    def told(s, wide):
        return ngram_join.counted(ngram_join.prints(s), len(s), wide)

    for size in (20, 400, 3000):
        for _ in range(60):
            pool = np.unique(np.concatenate([rng.integers(0, 1 << 63, size, np.uint64), rng.integers(0, 1 << 20, size, np.uint64)]))  # many agree in their high bits
            some = [np.unique(rng.choice(pool, int(rng.integers(1, len(pool) + 1)), replace=False)) for _ in range(4)]
            wide = all(len(s) > ngram_join.WIDE for s in some)
            whole = ngram_join.union([told(s, wide) for s in some[1:]])
            assert ngram_join.overlap(told(some[0], wide), whole) >= max(len(np.intersect1d(some[0], s)) for s in some[1:])


def test_repeated_ids_with_unlike_texts(spark):
    docs = [(1, " ".join(f"a{i}" for i in range(60))), (1, " ".join(f"b{i}" for i in range(60))), (2, " ".join(f"a{i}" for i in range(60))), (3, " ".join(f"b{i}" for i in range(59))), (3, " ".join(f"c{i}" for i in range(60)))]
    frame = spark.createDataFrame([*docs, docs[0]], "doc_id long, text string")
    kept = sorted((r.doc_id, r.text[:1]) for r in ngram_join.one_of_each(frame).collect())
    assert kept == [(1, "a"), (1, "b"), (3, "c")]


def test_edges(edge, empty):
    got = collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in ngram_join.join(edge).collect())
    assert got == brute([(r[0], r[1]) for r in rows()])
    assert ngram_join.join(empty).count() == 0
    kept = ngram_join.one_of_each(edge)
    assert kept.columns == edge.columns
    ids = [r.doc_id for r in kept.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 4, 5, 6, 8, 9, 10, 11, 12, 13] and ids.count(None) == 1
    assert ngram_join.one_of_each(empty).count() == 0


def test_components_of_a_chain(spark):
    links = spark.range(200).selectExpr("id AS a", "id + 1 AS b").union(spark.sql("SELECT 500L, 501L"))
    found = {r.node: r.label for r in components(links).collect()}
    assert found == {i: 0 for i in range(201)} | {500: 500, 501: 500}
    assert components(links.limit(0)).count() == 0


@pytest.mark.parametrize("most", [27, 12, 8])
def test_many_frequent_tokens_ask_no_pairs(spark, monkeypatch, most):
    """However small the table of frequent tokens is, none of them is missed, so shared lines bring no pairs together."""
    monkeypatch.setattr(ngram_join, "HOT_DOCS", 20)
    monkeypatch.setattr(ngram_join, "LEAST_BITS", 7)
    monkeypatch.setattr(ngram_join, "MOST_BITS", most)
    line = " ".join(f"licence{i}" for i in range(84))
    counts = {}
    for n in (200, 400):
        docs = [(i, " ".join(f"w{i}x{j}" for j in range(16)) + " " + line) for i in range(n)]
        queries, found = steps(spark, docs)
        counts[n] = queries.count(), found.count()
    if most > 8:  # with 256 bits, 80 shared tokens mark so many others that order alone no longer tells
        assert counts[400][0] <= 2 * counts[200][0] + 10 and counts[400][0] <= 4 * 400
    assert counts[400][1] <= 4 * counts[200][1] + 10


def test_the_table_of_frequent_tokens_misses_none(spark):
    rng = np.random.default_rng(4)
    tokens = rng.integers(0, 1 << 63, 5000, dtype=np.uint64) * np.uint64(2)
    scanned = spark.createDataFrame([(int(t.view(np.int64)), 100 if i % 5 else 3) for i, t in enumerate(tokens)], "token long, docs long")
    common = ngram_join._common(scanned)
    told = common.has(tokens)
    hot = np.arange(5000) % 5 > 0
    assert told[hot].all() and told[~hot].mean() < 0.06
    none = ngram_join._common(scanned.limit(0))
    assert not none.has(tokens).any()


def test_bounds_move_numbers_of_queries_and_contested_lists_only(spark):
    """Lists within one group don't count, a bound from contested lists is the same, and what moves by list is two numbers."""
    ensure_checkpoint_dir(spark)
    # Groups 1 (classes 1, 2) and 9 (class 9): list 5 is of group 1 alone, lists 6 and 7 are of both.
    entries = [(5, 1), (5, 2), (6, 1), (6, 2), (6, 9), (7, 2), (7, 9)]
    members = spark.createDataFrame([(x, 2, 3, c, True) for x, c in entries], "list long, size long, times long, node long, index boolean")
    grouped = spark.createDataFrame([(1, 10, 1, 1, 0), (2, 10, 2, 1, 0), (9, 10, 9, 9, 0)], "node long, n long, rep long, grp long, part long")
    open_ = ngram_join.contested(members, grouped)
    assert sorted((r.list, r.node) for r in open_.collect()) == [e for e in entries if e[0] != 5]
    queries = ngram_join.asked(members, grouped)
    assert sorted(queries.collect()) == sorted(ngram_join.asked(members, grouped, open_).collect())
    told = [sorted(ngram_join.qualified(queries, m, grouped).select("node", "n", "g", "part").collect()) for m in (members, open_)]
    assert told[0] == told[1] and {(r.node, r.g) for r in told[0]} == {(1, 9), (2, 9), (9, 1)}


def test_names_are_broadcast_only_where_sets_are_joined(spark, monkeypatch):
    """However small they are, joins of narrow rows are shuffled; what finished steps hold is let go of."""
    ensure_checkpoint_dir(spark)
    released = []
    monkeypatch.setattr(ngram_join.frames, "release", released.append)
    entries = [(5, 1), (5, 2), (6, 1), (6, 2), (6, 9), (7, 2), (7, 9)]
    members = spark.createDataFrame([(x, 2, 3, c, True) for x, c in entries], "list long, size long, times long, node long, index boolean")
    grouped = spark.createDataFrame([(1, 10, 1, 1, 0), (2, 10, 2, 1, 0), (9, 10, 9, 9, 0)], "node long, n long, rep long, grp long, part long")
    plans = []
    for module in (ngram_join, sys.modules[components.__module__]):
        monkeypatch.setattr(module, "kept", lambda frame: (frame.collect(), plans.append(frame._jdf.queryExecution().executedPlan().toString()), frame)[-1])
    open_ = ngram_join.contested(members, grouped)
    assert ngram_join.qualified(ngram_join.asked(members, grouped, open_), open_, grouped).count() == 3
    assert {r.label for r in components(grouped.selectExpr("grp AS a", "node AS b")).collect()} == {1}
    assert len(plans) > 6 and not any("BroadcastHashJoin" in p for p in plans)
    docs = spark.createDataFrame(made(3)[:40], "doc_id long, text string")
    monkeypatch.undo()
    monkeypatch.setattr(ngram_join.frames, "release", released.append)
    assert ngram_join.join(docs).count() == 40 and len(released) > 5


@pytest.mark.parametrize("counted", [1 << 22, 600])
def test_thinly_spread_lines_are_counted(monkeypatch, counted):
    """A line that no three texts of a slice share is counted over many slices, copies of a set once."""
    monkeypatch.setattr(ngram_join, "SLICE", 600)
    monkeypatch.setattr(ngram_join, "COUNTED", counted)
    line = " ".join(f"licence{i}" for i in range(24))
    texts = [" ".join(f"w{i}x{j}" for j in range(60)) + (" " + line if i % 4 == 0 else "") for i in range(80)]
    columns = [pa.array(range(81), pa.int64()), pa.array([*texts, texts[0]]), pa.array(range(81), pa.int64())]
    batches = [pa.RecordBatch.from_arrays([c.slice(k, 9) for c in columns], ["doc_id", "text", "row_key"]) for k in range(0, 81, 9)]
    out = [r for b in ngram_join._scanned(iter(batches)) for r in b.to_pylist()]
    assert [r["doc_id"] for r in out if r["token"] is None] == list(range(81))
    docs = collections.Counter()
    for r in out:
        if r["token"] is not None:
            docs[r["token"]] += r["docs"]
    assert len(docs) == 20
    assert set(docs.values()) == {20} if counted > 600 else all(3 <= n <= 20 for n in docs.values())


def test_release_lets_go_of_frames_in_cycles(spark):
    frame = spark.range(3)
    frame.own = frame
    gone = weakref.ref(frame)
    gc.disable()
    try:
        del frame
        frames.release(spark)
        assert gone() is None
    finally:
        gc.enable()


def test_a_family_does_not_ask_each_text_beside_it(spark):
    """Texts just too far from a family ask it, not each of its members them, whichever set is the smaller one."""
    ensure_checkpoint_dir(spark)
    family, beside = range(100, 140), range(20)
    for near, far in ((50, 45), (45, 50)):  # sizes; index tokens count in the smaller set
        sizes = {**dict.fromkeys(family, near), **dict.fromkeys(beside, far)}
        members = spark.createDataFrame([(7, 60, 1, c, n == 45) for c, n in sizes.items()], "list long, size long, times long, node long, index boolean")
        grouped = ngram_join.parted(spark.createDataFrame([(c, n, c, 100 if c >= 100 else c) for c, n in sizes.items()], "node long, n long, rep long, grp long"))
        queries = {(r.node, r.g) for r in ngram_join.asked(members, grouped).collect()}
        assert {q for q in queries if 100 in q or q[0] >= 100} == {(c, 100) for c in beside}
        assert len(queries) <= 20 + 20 * 19 // 2
