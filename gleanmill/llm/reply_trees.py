"""Reply trees to conversations: every root-to-leaf path, ranked by score, in one template.

Nodes name their parents. Self-joins enumerate the paths: in round k the known
members of each path are joined with the pointers to the 2**k-th ancestor, and
the pointers with themselves, so a tree of depth d takes log2(d) rounds and only
ids move. Texts are joined once the paths are known. Branches are ranked by the
mean score of their nodes; each chosen path becomes one conversation.

Template: a turn is ``<s>[role]text</s>``. In roles and texts ``\\ < [ ]`` are
written ``\\0 \\1 \\2 \\3``, so no control string can come from a text and reading
back is exact. The loss mask lists the places of assistant texts in the output,
in code points.

Defined results: a parent counts if it exists in the same tree, whatever the order
of the ids; nodes whose parents form a circle, and what replies to them, have no
root: the node of the circle with the smallest id starts a path there; null ids are
a tree or node of their own; rows with the same tree and node id are turns of
one node, in order of role and text; null roles and texts are empty; a null
score is 0; ties in score go to the smaller leaf id; an empty table gives no
conversation; other columns are ignored. One path is one output row, so one
path's turns meet in one task; several paths never do by need.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanmill.session import ensure_checkpoint_dir, table

CODES = (("\\", "\\0"), ("<", "\\1"), ("[", "\\2"), ("]", "\\3"))
OPEN, CLOSE, END = "<s>[", "]", "</s>"


def escaped(text: Column) -> Column:
    for sign, code in CODES:
        text = F.replace(text, F.lit(sign), F.lit(code))
    return text


def unescaped(text: Column) -> Column:
    for sign, code in reversed(CODES):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return text


def paths(nodes: DataFrame, top: int | None = None) -> DataFrame:
    """(tree_id, leaf_id, node_id, height, rank) of each path, height counted from the leaf.

    ``nodes`` has tree_id, node_id, parent_id and score. Paths are ranked in each
    tree by the mean score; with ``top`` only the best ones stay.
    """
    ensure_checkpoint_dir(nodes.sparkSession)
    known = nodes.groupBy("tree_id", "node_id").agg(F.min("parent_id").alias("parent_id"), F.avg(F.coalesce(F.col("score"), F.lit(0.0))).alias("score"))
    known = known.checkpoint()
    parent = known.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"))
    jump = known.join(parent, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("parent_id") == F.col("n")))
    jump = _cut(jump.select("tree_id", "node_id", F.col("parent_id").alias("up")).checkpoint())
    inner = jump.select(F.col("tree_id").alias("t"), F.col("up").alias("n"))
    member = known.join(inner, F.col("tree_id").eqNullSafe(F.col("t")) & F.col("node_id").eqNullSafe(F.col("n")), "left_anti")
    member = member.select("tree_id", F.col("node_id").alias("leaf_id"), "node_id", F.lit(0).cast("long").alias("height"))
    step = 1
    while not jump.isEmpty():
        up = jump.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), "up")
        on = F.col("tree_id").eqNullSafe(F.col("t"))
        higher = member.join(up, on & F.col("node_id").eqNullSafe(F.col("n"))).select("tree_id", "leaf_id", F.col("up").alias("node_id"), (F.col("height") + step).alias("height"))
        member = member.unionByName(higher).checkpoint()
        jump = jump.withColumnRenamed("up", "mid").join(up, on & (F.col("mid") == F.col("n"))).select("tree_id", "node_id", "up").checkpoint()
        step *= 2
    scores = known.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), F.col("score").alias("s"))
    ranked = (
        member.join(scores, F.col("tree_id").eqNullSafe(F.col("t")) & F.col("node_id").eqNullSafe(F.col("n")))
        .groupBy("tree_id", "leaf_id")
        .agg(F.avg("s").alias("mean"))
        .withColumn("rank", F.row_number().over(Window.partitionBy("tree_id").orderBy(F.col("mean").desc(), "leaf_id")))
    )
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    ranked = ranked.select(F.col("tree_id").alias("t"), F.col("leaf_id").alias("l"), "rank")
    return member.join(ranked, F.col("tree_id").eqNullSafe(F.col("t")) & F.col("leaf_id").eqNullSafe(F.col("l"))).drop("t", "l")


def _cut(jump: DataFrame) -> DataFrame:
    """Pointers to parents (tree_id, node_id, up) without those of the smallest node of each circle.

    Pointers are doubled while any are left. Chains run out after log2 of their
    length; what goes on beyond the number of pointers runs in a circle, and then
    every node still there points into one: its pointers lead to all nodes of it,
    and the smallest of these is found by taking minima along the doubled pointers.
    """
    if jump.filter("NOT up < node_id").isEmpty():  # pointers to smaller ids only form no circle
        return jump
    least = F.least("least", "more")
    far = jump.withColumn("least", F.col("up"))
    step, most = 1, None
    while True:
        up = far.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), F.col("up").alias("next"), F.col("least").alias("more"))
        longer = far.join(up, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("up") == F.col("n"))).select("tree_id", "node_id", F.col("next").alias("up"), least.alias("least")).checkpoint()
        if longer.isEmpty():
            return jump
        step *= 2
        far = longer
        if most is None:
            most = jump.groupBy("tree_id").count().agg(F.max("count")).first()[0]
        if step > most:
            break
    # A node of a circle is one that a pointer of that length comes from and that some such pointer leads to; its minimum is the circle's.
    on = far.select(F.col("tree_id").alias("t"), F.col("up").alias("n")).distinct()
    circle = far.join(on, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("node_id") == F.col("n")))
    first = circle.filter(F.col("node_id") == F.col("least")).select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"))
    return jump.join(first, F.col("tree_id").eqNullSafe(F.col("t")) & (F.col("node_id") == F.col("n")), "left_anti").checkpoint()


def formatted(nodes: DataFrame, top: int | None = None) -> DataFrame:
    """(tree_id, leaf_id, rank, formatted, loss_mask): one row per chosen path.

    ``nodes`` has tree_id, node_id, parent_id, role, text and score.
    """
    chosen = paths(nodes, top)
    texts = nodes.select(F.col("tree_id").alias("t"), F.col("node_id").alias("n"), escaped(F.coalesce("role", F.lit(""))).alias("role"), escaped(F.coalesce("text", F.lit(""))).alias("text"))
    turns = chosen.join(texts, F.col("tree_id").eqNullSafe(F.col("t")) & F.col("node_id").eqNullSafe(F.col("n")))
    # Places by a running sum over the turns of a path, so that the work grows with the text alone.
    order = Window.partitionBy("tree_id", "leaf_id").orderBy((-F.col("height")).alias("o"), "role", "text").rowsBetween(Window.unboundedPreceding, -1)
    size = F.length("role") + F.length("text") + len(OPEN) + len(CLOSE) + len(END)
    at = F.coalesce(F.sum(size.cast("long")).over(order), F.lit(0)) + F.length("role") + len(OPEN) + len(CLOSE)
    placed = turns.withColumn("start", at.cast("long")).withColumn("end", (F.col("start") + F.length("text")).cast("long"))
    turn = F.struct(F.col("start").alias("start"), "end", "role", "text")  # starts rise along a path
    whole = placed.groupBy("tree_id", "leaf_id", "rank").agg(F.sort_array(F.collect_list(turn)).alias("turns"))
    return whole.select(
        "tree_id",
        "leaf_id",
        "rank",
        F.array_join(F.transform("turns", lambda x: F.concat(F.lit(OPEN), x["role"], F.lit(CLOSE), x["text"], F.lit(END))), "").alias("formatted"),
        F.transform(F.filter("turns", lambda x: x["role"] == "assistant"), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("loss_mask"),
    )


def turns_of(text: Column) -> Column:
    """Array of (role, text) read back from a formatted conversation."""
    pieces = F.filter(F.split(text, END), lambda p: p != "")
    bodies = F.transform(pieces, lambda p: F.substring(p, len(OPEN) + 1, 2147483647))
    return F.transform(
        bodies,
        lambda b: F.struct(unescaped(F.substring_index(b, CLOSE, 1)).alias("role"), unescaped(F.substr(b, F.instr(b, CLOSE) + 1)).alias("text")),
    )


#: Code points of a block; a span is cut out of the blocks that it lies in, not counted from the start of the text.
BLOCK = 4096


def masked(text: Column, mask: Column) -> Column:
    """All text under the loss mask, in order, as it was before escaping."""
    count = F.floor((F.length(text) + (BLOCK - 1)) / BLOCK).cast("int")
    blocks = F.transform(F.sequence(F.lit(0), F.greatest(count - 1, F.lit(0))), lambda i: F.substr(text, i * BLOCK + 1, F.lit(BLOCK)))

    def cut(blocks: Column, span: Column) -> Column:
        first, last = F.floor(span["start"] / BLOCK).cast("int"), F.floor(span["end"] / BLOCK).cast("int")
        near = F.array_join(F.slice(blocks, first + 1, last - first + 1), "")
        return unescaped(F.substr(near, (span["start"] % BLOCK + 1).cast("int"), (span["end"] - span["start"]).cast("int")))

    # The blocks are bound once, whatever the number of spans.
    return F.transform(F.array(blocks), lambda b: F.array_join(F.transform(mask, lambda s: cut(b, s)), ""))[0]


CHECK_TURNS = "VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)"


def thread_nodes(conversations: DataFrame) -> DataFrame:
    """A table of turns as trees in which each turn replies to the one before it."""
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    return conversations.select(
        F.col("conv_id").alias("tree_id"),
        F.row_number().over(order).cast("long").alias("node_id"),
        (F.row_number().over(order) - 1).cast("long").alias("parent_id"),
        "role",
        "text",
        F.lit(0.0).alias("score"),
    )


def op9_reply_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation in the template, with digests of what is read back from it."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    out = formatted(thread_nodes(rows.unionByName(spark.sql(f"SELECT * FROM {CHECK_TURNS}"))))
    told = out.select("tree_id", "formatted", "rank", turns_of(F.col("formatted")).alias("turns"), masked(F.col("formatted"), F.col("loss_mask")).alias("loss"))
    return told.select(
        F.col("tree_id").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "rank",
    )


ORACLE_SQL = """
WITH raw AS (
  SELECT conv_id, turn, role, text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS n,
         coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM raw
), sized AS (
  SELECT *, length(role) + length(text) + len(regexp_extract_all(role || text, '[\\\\<\\[\\]]')) + length('<s>[]</s>') AS chars FROM turns
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars, 1 AS rank
FROM sized GROUP BY conv_id
"""
