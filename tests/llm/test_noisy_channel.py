import itertools
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from gleanmill.llm import noisy_channel as nc
from gleanmill.llm import registry
from gleanmill.llm.arrow_text import flat_utf8
from gleanmill.session import ensure_checkpoint_dir, table
from tests.conftest import DATA
from tests.llm.conftest import PROSE

INSULTS = "idiot stupid moron pathetic scum worthless trash clown".split()
CLEAN = (PROSE + " small ideas need good books all summer and a coffee makes the still evening better for everyone who sees the sea").lower().split()


def prose(r, n, words=CLEAN):
    return " ".join(r.choice(words) for _ in range(n))


@pytest.fixture(scope="module")
def cost():
    r = random.Random(4)
    text = prose(r, 6000, CLEAN * 3 + INSULTS) + " 2024 at 10.30 the 2nd time!! wait... well-known"
    return nc.costs(np.bincount(nc.word_grams(*flat_utf8(pa.array([text]))), minlength=nc.SYMBOLS**4).astype(float))


def test_grams_by_plain_loops():
    texts = ["The 1st idea, naïve! (yes", "", None, "a  b", "x", "st.upid 1d10t well-known so!!", "...end"]
    want = {}
    for token in " ".join((t or "").lower() for t in texts).split():
        runs = "".join(c if nc._symbol(c) else " " for c in token).split()
        if len(runs) != 1 or any(c in nc.LOOKS or c in nc.STARS for c in token):
            continue
        context = (0, 0, 0)
        for symbol in [*map(nc._symbol, runs[0]), 0]:
            want[(*context, symbol)] = want.get((*context, symbol), 0) + 1
            context = (*context[1:], symbol)
    found = {}
    for g in nc.word_grams(*flat_utf8(pa.array(texts))).tolist():
        key = tuple(g // nc.SYMBOLS**i % nc.SYMBOLS for i in (3, 2, 1, 0))
        found[key] = found.get(key, 0) + 1
    assert found == want


def test_costs_are_probabilities(cost):
    rows = np.exp(-cost.reshape(-1, nc.SYMBOLS).astype(float)).sum(1)
    assert np.allclose(rows, 1, atol=1e-5)


def every_path(token):
    """(what is said, symbols, cost of the channel) of every path of the lattice, by its definition."""
    choices = []
    for i, c in enumerate(token):
        symbol = nc._symbol(c)
        some = [(c, symbol, nc.KEEP_COST if c in nc.LOOKS and not symbol else 0.0)]
        if i and c == token[i - 1] and "a" <= c <= "z":
            some.append(("", None, nc.AGAIN_COST))
        some += [(x, ord(x) - 96, nc.SIGN_COST) for x in nc.LOOKS.get(c, "")]
        if 0 < i < len(token) - 1 and (c in " " + nc.APART + nc.STARS) and token[i - 1] not in nc.APART:
            some.append(("", None, nc.APART_COST))
            if c in nc.STARS and nc._symbol(token[i - 1]) and nc._symbol(token[i + 1]):
                some += [(chr(96 + x), x, nc.STAR_COST) for x in range(1, 27)]
        choices.append(some)
    for path in itertools.product(*choices):
        yield "".join(p[0] for p in path), [p[1] for p in path if p[1] is not None], sum(p[2] for p in path)


def cost_of(symbols, cost):
    total, context = 0.0, (0, 0, 0)
    for s in [*symbols, 0]:
        if s or context != (0, 0, 0):
            total += cost[((context[0] * nc.SYMBOLS + context[1]) * nc.SYMBOLS + context[2]) * nc.SYMBOLS + s]
        context = (*context[1:], s) if s else (0, 0, 0)
    return total


def test_viterbi_against_every_path(cost):
    r = random.Random(9)
    tokens = ["1d10t", "st*pid", "s.c.u.m", "mooor0n", "s c u m", "a-b", "!!", "x..y", "aa", "w0rth1e$s", "é1a", "*a*", "bookk", "m*r*n"]
    tokens += ["".join(r.choice("aaiidot10!*.-s$e") for _ in range(r.randint(2, 7))) for _ in range(150)]
    restorer = nc.Restorer(cost)
    for token in tokens:
        if token.count("*") > 2:
            continue
        said = restorer.decoded(token)
        best = min(extra + cost_of(symbols, cost) for _, symbols, extra in every_path(token))
        own = min(extra + cost_of(symbols, cost) for text, symbols, extra in every_path(token) if text == said)
        assert math.isclose(own, best, rel_tol=1e-5, abs_tol=1e-4), (token, said)


def test_restores_insults_and_leaves_words(cost):
    restorer = nc.Restorer(cost)
    bent = {"1d10t": "idiot", "idi0t": "idiot", "st*pid": "stupid", "s.t.u.p.i.d": "stupid", "s-c-u-m": "scum", "stuuupid": "stupid", "m0r0n": "moron", "tr@sh": "trash", "cl0wn": "clown", "M O R O N": "moron", "p4theeetic": "pathetic", "іdiot": "idiot"}
    for said, meant in bent.items():
        assert restorer.text(said) == meant
    plain = " ".join(CLEAN)
    assert restorer.text(plain) == plain and restorer.text("Good books,\n\tall summer ...") == "good books,\n\tall summer ..."
    assert restorer.text("") == "" and len(restorer.text("a" * 50_000)) <= 50_000 and restorer.text("1 " * 30_000)


def labelled(n, seed=1):
    r = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        words = prose(r, r.randint(20, 60)).split()
        for _ in range(r.randint(1, 3) if bad else 0):
            words.insert(r.randrange(len(words)), r.choice(INSULTS))
        rows.append((i, " ".join(words)))
        labels.append((i, int(bad)))
    return rows, labels


def test_bent_insults_in_held_out_rows(spark):
    rows, labels = labelled(1500)
    r = random.Random(2)
    bend = {"o": "0", "i": "1", "s": "$", "a": "@", "e": "3"}
    held = [zlib.crc32(str(i).encode()) % 5 == 0 for i, _ in rows]
    bent = [(i, " ".join("".join(bend.get(c, c) if r.random() < 0.5 else c for c in w) if w in INSULTS else w for w in t.split()) if h else t) for (i, t), h in zip(rows, held, strict=True)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1, 0.5) for i, t in bent], "doc_id long, text string, lang string, source string, predicted int, score double").repartition(5)
    found = {x.doc_id: x for x in nc.toxicity(docs, spark.createDataFrame(labels, "doc_id long, toxic int")).collect()}
    assert len(found) == 1500 and all(x.held_out == h for x, h in zip((found[i] for i in range(1500)), held, strict=True))
    wrong = [i for i, y in labels if held[i] and found[i].predicted != y]
    assert len(wrong) <= 0.05 * sum(held) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in found.values())


def test_copies_and_edges(spark, edge):
    rows, labels = labelled(400)
    many = [(10_000 + i, rows[0][1]) for i in range(3000)]  # one text is most of the table and of the labels
    docs = spark.createDataFrame(rows + many, "doc_id long, text string").repartition(6)
    told = spark.createDataFrame(labels + [(i, 1) for i, _ in many] + [(None, 1), (1, None), (77_777, 1)], "doc_id long, toxic int")
    found = nc.toxicity(docs, told, sample_rows=200).collect()
    assert sum(x.predicted == (x.doc_id % 4 == 0 or x.doc_id >= 10_000) for x in found) >= 0.97 * len(found)
    assert len({x.score for x in found if x.doc_id >= 10_000 or x.doc_id == 0}) == 1
    ensure_checkpoint_dir(spark)
    out = nc.toxicity(edge, told)
    got = {x.doc_id: x for x in out.collect()}
    assert out.count() == edge.count() and got[4].score == got[5].score and not got[None].held_out
    assert nc.restored(edge).filter("text IS NULL").count() == edge.filter("text IS NULL").count()


@pytest.mark.parametrize("labels, score", [([], 0.0), ([(0, 1), (1, 1), (2, 1), (3, 1), (4, 1)], None)])
def test_nothing_to_learn(spark, empty, labels, score):
    rows, _ = labelled(20)
    docs, told = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    found = {x.score for x in nc.toxicity(docs, told).collect()}
    n = sum(zlib.crc32(str(i).encode()) % 5 != 0 for i, _ in labels)
    assert found == {score if score is not None else (n + 1) / (n + 2)}
    assert nc.toxicity(empty, told).collect() == []


def test_registered_over_the_whole_table(spark):
    found = registry.queries()["op11_noisy_channel"](spark, DATA)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"] and found.count() == table(spark, DATA, "documents").count()
