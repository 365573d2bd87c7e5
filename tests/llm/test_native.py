"""Quality rules, mixing and reply trees: against SQL, brute force and edge cases."""

import math
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from gleanmill.llm import pfair_mixing as mixing
from gleanmill.llm import quality_rules as quality
from gleanmill.llm import registry, reply_trees
from gleanmill.session import ensure_checkpoint_dir
from tests.conftest import DATA, same_rows
from tests.llm.conftest import rows


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    same_rows(registry.queries()[name](spark, DATA), duck.sql(registry.oracle_sql()[name]))


def test_native_plans(spark):
    for name in ("op2_pfair_mixing", "op8_quality_rules", "op9_reply_trees"):
        plan = registry.queries()[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_binomial_tail(spark):
    for k, n, p in ((0, 10, 0.01), (3, 500, 0.01), (0, 0, 0.01), (40, 10000, 0.005), (9, 10, 0.5)):
        exact = float(sum(Fraction(math.comb(n, i)) * Fraction(p) ** i * (1 - Fraction(p)) ** (n - i) for i in range(k + 1)))
        got = spark.range(1).select(quality.binomial_tail(F.lit(k).cast("long"), F.lit(n).cast("long"), p).alias("x")).first().x
        assert got == pytest.approx(1.0 if k >= n * p else exact, rel=1e-9)


def test_cutoffs_keep_their_promise(spark):
    ensure_checkpoint_dir(spark)
    n = 40000
    measures = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("=x").alias("stratum"), F.lit(100).cast("long").alias("n_words"), F.lit(400).cast("long").alias("word_chars"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).cast("long").alias("n_symbols"), F.lit(10).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dup_lines"), F.lit(0).cast("long").alias("n_repeat_words"),
    )
    labels = spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))
    cut = quality.certified_cutoffs(measures, labels).first()
    lost = measures.filter(F.col("n_symbols") > cut.cut_symbols).count() / n if cut.cut_symbols is not None else 0
    assert cut.cut_symbols is not None and lost <= quality.ALPHA / len(quality.RULES) and cut.cut_word_length == 6.0
    few = quality.certified_cutoffs(measures.limit(50), labels).first()
    assert few.cut_symbols is None


def good_and_poor(n):
    """Documents of three languages, most of them good by their labels; a few good ones have many symbols, so have all poor ones."""
    out = []
    for i in range(n):
        lang = ("en", "de", "fr")[i % 3]
        poor, marked = i % 10 == 9, i % 5003 == 1
        words = [f"w{i}x{j}" for j in range(60)] + (["#"] * 40 if poor or marked else []) + ["x" * (12 + i % 3)] * (30 if i % 90 == 89 else 0)
        lines = [" ".join(words[:30]), " ".join(words[30:])] + (["same line here"] * 6 if i % 20 == 19 else [])
        out.append((i, "\n".join(lines), lang, i % 7 != 0, int(not poor)))
    return out


def test_cutoffs_in_several_strata(spark, tmp_path):
    import duckdb

    rows = good_and_poor(7200)
    folder = str(tmp_path)
    spark.createDataFrame([r[:3] for r in rows], "doc_id long, text string, lang string").write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(r[0], r[4], 0) for r in rows if r[3]], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    db = duckdb.connect()
    for name in ("documents", "labels"):
        db.sql(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet/*.parquet'")
    got = quality.op8_quality_rules(spark, folder)
    same_rows(got, db.sql(quality.ORACLE_SQL))
    found = {r.lang: r for r in got.join(spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "lang"), "doc_id").groupBy("lang").agg(F.count_if(F.expr("n_failed_rules > 0")).alias("failed"), F.count_if(F.col("n_failed_rules").isNull()).alias("none")).collect()}
    assert len(found) == 3 and all(r.failed > 100 and r.none == 0 for r in found.values())
    docs, labels = (spark.read.parquet(f"{folder}/{n}.parquet") for n in ("documents", "labels"))
    assert {r.doc_id for r in quality.keep_good(docs, labels).select("doc_id").collect()} == {r.doc_id for r in got.filter("kept").collect()}


def test_fixed_sequence_stops_at_the_first_failure(spark):
    ensure_checkpoint_dir(spark)
    n = 3000
    # Good documents have 0 to 3 symbols of 100 words, so 2 fails and 5 passes; repeats fail at 45 and, though no cutoff below could differ, none is taken.
    measures = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("=x").alias("stratum"), F.lit(100).cast("long").alias("n_words"), F.lit(400).cast("long").alias("word_chars"), F.expr("id % 4").alias("n_symbols"),
        F.lit(10).cast("long").alias("n_lines"), F.lit(0).cast("long").alias("n_dup_lines"), F.expr("if(id % 50 = 0, 48L, 0L)").alias("n_repeat_words"),
    )
    cut = quality.certified_cutoffs(measures, spark.range(n).select(F.col("id").alias("doc_id"), F.lit(1).alias("quality"))).first()
    assert (cut.cut_symbols, cut.cut_dup_lines, cut.cut_repeats, cut.cut_word_length) == (5.0, 5.0, None, 6.0)


def test_quality_edges(spark, edge, empty):
    labels = spark.sql("SELECT * FROM (VALUES (1L, 1), (1L, 1), (NULL, 1), (99L, 0), (2L, NULL)) AS t(doc_id, quality)")
    kept = quality.keep_good(edge, labels)
    assert kept.columns == edge.columns and sorted(r.doc_id for r in kept.collect()) == [1, 1, 2, 3]
    assert quality.keep_good(empty, labels).count() == 0 and quality.keep_good(edge, labels.limit(0)).count() == 4
    m = {r.doc_id: r for r in quality.measured(edge).collect()}
    assert (m[5].n_words, m[10].n_words, m[13].n_dup_lines, m[13].n_symbols) == (0, 0, 2, 9)
    assert m[8].n_words == 80000 and m[8].n_repeat_words == 60000
    twice = spark.sql("SELECT 1L AS doc_id, 'a b c x a b c y a a a a' AS text, 'e' AS lang")
    assert quality.measured(twice).first().n_repeat_words == 10


def simulate(blocks, weights):
    """Slot by slot: (source, block, release, deadline) with phases as the module describes."""
    keys, rest, out = sorted(blocks), dict(blocks), []
    used = dict.fromkeys(blocks, 0)
    while any(rest.values()):
        live = [k for k in keys if rest[k]]
        p, done, began, t = sum(weights[k] for k in live), dict.fromkeys(live, 0), len(out), 0
        while all(rest[k] for k in live):
            ready = [(-(-(done[k] + 1) * p // weights[k]), k) for k in live if done[k] * p // weights[k] <= t]
            deadline, k = min(ready)
            out.append((k, used[k], began + done[k] * p // weights[k], began + deadline))
            for s in live:  # the deviation stays below one block
                assert abs(done[s] + (s == k) - Fraction((t + 1) * weights[s], p)) < 1
            done[k], used[k], rest[k], t = done[k] + 1, used[k] + 1, rest[k] - 1, t + 1
    return out


@pytest.mark.parametrize("weights", [None, {"=a": 7, "=b": 5, "=c": 3, "=d": 1}, {"=a": 1, "=b": 9}])
def test_mix_against_simulation(spark, weights):
    sizes = {"=a": 100, "=b": 37, "=c": 8, "=d": 1}
    data = spark.createDataFrame([(i * 10 + j, k[1:], "x") for j, (k, n) in enumerate(sizes.items()) for i in range(n)], "doc_id long, source string, slot string")
    got = mixing.mix(data, block_rows=4, weights=weights).select("row.doc_id", "key", "block", "slot", "release", "deadline", "position").collect()
    most = max(sizes.values())
    used = {k: max(1, math.floor(math.sqrt(n) / math.sqrt(most) * 32 + 0.5)) for k, n in sizes.items()} if weights is None else {k: weights.get(k, 1) for k in sizes}
    plan = simulate({k: -(-n // 4) for k, n in sizes.items()}, used)
    assert len(got) == sum(sizes.values()) and sorted(r.position for r in got) == list(range(len(got)))
    assert {(r.key, r.block, r.slot, r.release, r.deadline) for r in got} == {(k, b, slot, r, d) for slot, (k, b, r, d) in enumerate(plan)}
    by_position = sorted(got, key=lambda r: r.position)
    assert [r.slot for r in by_position] == sorted(r.slot for r in got)
    assert all(r.release <= r.slot < r.deadline for r in got)


def test_mix_edges(spark, edge, empty):
    out = mixing.interleave(edge, block_rows=2)
    assert out.columns == edge.columns and out.count() == len(rows())
    assert mixing.interleave(empty).count() == 0
    keys = {r.key for r in mixing.mix(edge).select("key").distinct().collect()}
    assert keys == {"=s1", "=s2", "=", "null"}


def test_branching_trees(spark):
    data = [
        (1, 1, None, "user", "root <s>[x] \\1", 0.0), (1, 2, 1, "assistant", "left", 1.0), (1, 3, 1, "assistant", "right", 5.0), (1, 4, 3, "user", "", 2.0), (1, 5, 4, None, None, None),
        (2, 7, 99, "user", "orphan", 1.0), (2, 8, 8, "assistant", "own parent", 1.0), (2, 9, 10, "user", "forward", 1.0), (2, 10, 9, "assistant", "back", 1.0), (None, 1, None, "user", "no tree", 1.0),
    ]
    nodes = spark.createDataFrame(data, "tree_id long, node_id long, parent_id long, role string, text string, score double")
    members = {}
    for r in reply_trees.paths(nodes).collect():
        members.setdefault((r.tree_id, r.leaf_id), []).append((r.height, r.node_id))
    assert {k: [n for _, n in sorted(v, reverse=True)] for k, v in members.items()} == {(1, 2): [1, 2], (1, 5): [1, 3, 4, 5], (2, 7): [7], (2, 8): [8], (2, 10): [9, 10], (None, 1): [1]}
    ranks = {(r.tree_id, r.leaf_id): r["rank"] for r in reply_trees.paths(nodes).collect()}
    assert ranks == {(1, 5): 1, (1, 2): 2, (2, 7): 1, (2, 8): 2, (2, 10): 3, (None, 1): 1}
    best = reply_trees.formatted(nodes, top=1).collect()
    assert {(r.tree_id, r.leaf_id) for r in best} == {(1, 5), (2, 7), (None, 1)}
    back = reply_trees.formatted(nodes).select("leaf_id", "tree_id", reply_trees.turns_of(F.col("formatted")).alias("turns"), reply_trees.masked(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()
    told = {(r.tree_id, r.leaf_id): ([(t.role, t.text) for t in r.turns], r.loss) for r in back}
    assert told[(1, 5)] == ([("user", "root <s>[x] \\1"), ("assistant", "right"), ("user", ""), ("", "")], "right")
    assert told[(1, 2)][1] == "left" and reply_trees.formatted(nodes.limit(0)).count() == 0


def test_deep_thread_and_escapes(spark):
    hard = "</s>[INST]\\0\\1\\\\<[]\n" * 3
    turns = [(1, i, "assistant" if i % 2 else "user", f"{i}{hard}") for i in range(70)] + [(1, 3, "user", "same turn"), (2, None, None, None)]
    table = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")
    out = reply_trees.formatted(reply_trees.thread_nodes(table)).select("tree_id", reply_trees.turns_of(F.col("formatted")).alias("t"), reply_trees.masked(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()
    got = {r.tree_id: r for r in out}
    expected = sorted([t for t in turns if t[0] == 1], key=lambda t: (t[1], t[2], t[3]))
    assert [(x.role, x.text) for x in got[1].t] == [(t[2], t[3]) for t in expected]
    assert got[1].loss == "".join(t[3] for t in expected if t[2] == "assistant") and len(got[2].t) == 1


def test_circles_and_unordered_ids(spark):
    # 3 -> 9 -> 5 is a path whose ids are in no order; 1 -> 2 -> 3 -> 1 is a circle with a reply; ids that are texts.
    data = [("a", "r9", None), ("a", "z1", "r9"), ("a", "b5", "z1"), ("a", "c7", "z1"), ("c", "1", "3"), ("c", "2", "1"), ("c", "3", "2"), ("c", "4", "2"), ("c", "7", "7")]
    nodes = spark.createDataFrame([(*d, "user", d[1], 0.0, "x") for d in data], "tree_id string, node_id string, parent_id string, role string, text string, score double, up string")
    members = {}
    for r in reply_trees.paths(nodes).collect():
        members.setdefault((r.tree_id, r.leaf_id), []).append((r.height, r.node_id))
    got = {k: [n for _, n in sorted(v, reverse=True)] for k, v in members.items()}
    assert got == {("a", "b5"): ["r9", "z1", "b5"], ("a", "c7"): ["r9", "z1", "c7"], ("c", "3"): ["1", "2", "3"], ("c", "4"): ["1", "2", "4"], ("c", "7"): ["7"]}


def test_many_sources(spark):
    sizes = {f"={i:03d}": 1 + (i * 37) % 90 for i in range(300)}
    data = spark.createDataFrame([(j * 1000 + i, k[1:]) for j, (k, n) in enumerate(sizes.items()) for i in range(n)], "doc_id long, source string")
    got = mixing.mix(data, block_rows=4).select("key", "block", "slot", "release", "deadline", "position").collect()
    used = {k: max(1, math.floor(math.sqrt(n) / math.sqrt(max(sizes.values())) * 32 + 0.5)) for k, n in sizes.items()}
    plan = simulate({k: -(-n // 4) for k, n in sizes.items()}, used)
    assert sorted(r.position for r in got) == list(range(sum(sizes.values())))
    assert {(r.key, r.block, r.slot, r.release, r.deadline) for r in got} == {(k, b, slot, r, d) for slot, (k, b, r, d) in enumerate(plan)}


def test_rows_without_ids_are_no_hot_key(spark):
    data = spark.range(3000).selectExpr("CAST(NULL AS LONG) AS doc_id", "'s' AS source", "CAST(id AS STRING) AS text")
    out = mixing.mix(data)
    assert sorted(r.position for r in out.select("position").collect()) == list(range(3000))


def test_conversations_with_other_columns_and_long_texts(spark, empty):
    long = "word [x] </s> " * 100_000
    data = [(1, 0, "user", long, 9, 9, "l", 9.0, 9, "f"), (1, 1, "assistant", "short", 9, 9, "l", 9.0, 9, "f"), (1, 1, "assistant", "short", 9, 9, "l", 9.0, 9, "f")]
    table = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, t long, n long, l string, s double, `rank` int, formatted string")
    nodes = reply_trees.thread_nodes(table).withColumns({c: F.lit(7) for c in ("t", "n", "l", "s", "mean", "rank", "height", "leaf_id", "up", "least")})
    out = reply_trees.formatted(nodes).select(reply_trees.turns_of(F.col("formatted")).alias("t"), reply_trees.masked(F.col("formatted"), F.col("loss_mask")).alias("loss"), "rank").collect()
    assert [(x.role, x.text) for x in out[0].t] == [("user", long), ("assistant", "short"), ("assistant", "short")] and out[0].loss == "shortshort" and out[0]["rank"] == 1
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert reply_trees.formatted(reply_trees.thread_nodes(none)).count() == 0


def test_long_conversations_take_linear_time(spark):
    import time

    took = {}
    for n in (1000, 2000, 16000):  # the first run compiles
        turns = [(1, i, "assistant" if i % 2 else "user", f"turn {i} " + "é[<\\" * (i % 50)) for i in range(n)]
        nodes = reply_trees.thread_nodes(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string"))
        began = time.time()
        row = reply_trees.formatted(nodes).select("formatted", "loss_mask", reply_trees.turns_of(F.col("formatted")).alias("t"), reply_trees.masked(F.col("formatted"), F.col("loss_mask")).alias("loss")).collect()[0]
        took[n] = time.time() - began
        assert [(x.role, x.text) for x in row.t] == [(r, x) for _, _, r, x in turns] and row.loss == "".join(x for _, _, r, x in turns if r == "assistant")
        assert [row.formatted[s.start : s.end] for s in row.loss_mask] == [_escaped(x) for _, _, r, x in turns if r == "assistant"]
    assert took[16000] < 3 * took[2000], took


def _escaped(text):
    for sign, code in reply_trees.CODES:
        text = text.replace(sign, code)
    return text


def test_spans_across_blocks(spark):
    text = "".join(chr(97 + i % 26) if i % 7 else "é" for i in range(3 * reply_trees.BLOCK + 5))
    cuts = [(0, 0), (0, 1), (5, reply_trees.BLOCK), (reply_trees.BLOCK - 1, reply_trees.BLOCK + 1), (10, len(text)), (reply_trees.BLOCK, 3 * reply_trees.BLOCK), (len(text), len(text))]
    frame = spark.createDataFrame([(text, cuts), ("", [(0, 0)]), ("", [])], "t string, m array<struct<start:bigint,end:bigint>>")
    assert [r.x for r in frame.select(reply_trees.masked(F.col("t"), F.col("m")).alias("x")).collect()] == ["".join(text[a:b] for a, b in cuts), "", ""]
