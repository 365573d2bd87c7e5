"""Exact Jaccard join on word shingles by a token-group matrix.

Two documents link when 5 * |A & B| >= 4 * |A | B| over their shingle sets.

1. Documents with equal sets form a class, named by a 64-bit hash of the set;
   classes are what is compared from here on.
2. Sets are ordered by (frequent, hash). Of a linked pair, one of the first
   n - ceil(8n/9) + 1 tokens of the smaller set (its index tokens) is among the
   first n - ceil(4n/5) + 1 of the other (its probe tokens); only these are
   matched. Frequent tokens, such as those of passages that many documents share,
   come last: all that ``HOT_DOCS`` documents have by counts over some 25 MB of
   texts at a time, in each of those that have them three times. Tasks know them by a table of ``BITS`` bits for each, which misses none
   and grows with their number, up to ``MOST_BITS`` (16 MB); beyond, more of the other
   tokens count as frequent too (a fifth for 33 million frequent ones). Any such order is
   right, a good one is fast: a passage that is less
   than eight ninths of a document is never among its index tokens, so documents
   that share no more than that do not meet.
   A linked pair also shares o - ceil(4m/5) + 1 of its probe tokens, with o =
   ceil(4/9 (a + b)) for sizes a and b and m the larger one.
3. Similar documents are partitioned into groups: of the documents that meet over
   a token, each is compared with the one it meets most, if they share enough
   probe tokens; the links found give the groups. A document that links with none
   is a group of its own.
4. Token-group matrix: a group is kept in parts of about ``PART`` documents, and
   of each part the union of its tokens to match is stored, one row per token (or
   per set of tokens that the same documents have) and part. Where two groups meet
   over an index token of either, the documents of the smaller one that meet the other
   are queries; so a large family does not ask each text that is just too far from it. Its tokens are counted in
   the unions of that group's parts; a part qualifies if the count reaches what a
   link with one of its sizes needs. Then the whole sets are bounded in the same
   way, by unions of 16 bits of every token (32 bits of sets with over
   ``WIDE`` tokens), counted so that no overlap is told too small. Only the parts
   that still qualify are opened: sets are shipped first to the best part of each
   group, then to the others for the queries that did not link there. One link
   joins two groups.
5. Components of all links are final: pairs never compared are either in one
   component already, or share no token that a linked pair must share.

Copies are never paired with each other and no list is expanded into pairs of
documents: a list gives one row per member, and (query, group) pairs only
between groups that are still apart. Lists, groups and partners with many rows
are spread over salts.

Texts are hashed for the classes and for the tokens to match; after that only those
of documents that are compared.

Defined results: a null or empty text has no shingles and its own id as
component; a null id takes part only through documents of equal text; rows that
repeat an id each get the component of their own text; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.llm import frames
from gleanmill.llm.arrow_text import release, slices
from gleanmill.llm.components import components
from gleanmill.llm.frames import kept, side
from gleanmill.llm.shingles import mix, sets
from gleanmill.session import ensure_checkpoint_dir, table

HOT_DOCS = 48
#: Bits of the table of frequent tokens for each of them, and the fewest and most of a table, as powers of two.
BITS = 32
LEAST_BITS, MOST_BITS = 16, 27
PART = 64
#: Ids or names of at most so many rows are broadcast to the texts; more are joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: The same where names of some columns are joined with sets that are moved on by another key.
BROADCAST_NAMES = 200_000
CHUNK = 512
WIDE = 1024
#: Rows of one key that go to one task before the key is salted.
CROWD = 4096
#: Bytes of text hashed at a time; the arrays take some forty times as much.
SLICE = 5 << 18
#: Tokens of so many are counted together (8 bytes each, twice while they are sorted): the texts of a task, or about 25 MB of them.
COUNTED = 1 << 22
_LONGS = pa.list_(pa.int64())


def needed(n):
    """Tokens that a set of n must share with any linked set: ceil(0.8 n)."""
    return (4 * n + 4) // 5


def least_index(n):
    """Tokens that a set of n must share with a linked set that is not smaller: ceil(8n/9)."""
    return (8 * n + 8) // 9


def row_key() -> Column:
    """64 bits that name a row by its id and text."""
    return F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")), F.col("text").cast("string"))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))


def _node(s: np.ndarray) -> int | None:
    """The name of a set: a hash of its tokens and their number."""
    return int((mix(s + np.uint64(1)).sum(dtype=np.uint64) + np.uint64(len(s))).view(np.int64)) if len(s) else None


def _scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two kinds of rows: (doc_id, row_key, n, node) of each text, and (token, docs) for tokens in three or more of the sets counted together."""
    held: dict[int, np.ndarray] = {}
    size = 0
    for rows, raw, offsets in slices(batches, "text", SLICE):
        every = list(sets(raw, offsets))
        nodes = [_node(s) for s in every]
        none = pa.nulls(len(every), pa.int64())
        yield _rows(rows.column(0), rows.column(2), pa.array([len(s) for s in every], pa.int64()), pa.array(nodes, pa.int64()), none, none)
        for k, s in zip(nodes, every, strict=True):
            if k is not None and k not in held:
                held[k] = s
                size += len(s)
        if size >= COUNTED:
            yield _repeated(held)
            held, size = {}, 0
    if held:
        yield _repeated(held)
    release()


def _rows(*columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns), ["doc_id", "row_key", "n", "node", "token", "docs"])


def _repeated(held: dict[int, np.ndarray]) -> pa.RecordBatch:
    """(token, docs) of the tokens in three or more of these sets, which are let go of."""
    tokens = np.concatenate(list(held.values()))
    held.clear()
    tokens.sort()
    again, docs = np.unique(tokens[2:][tokens[2:] == tokens[:-2]], return_counts=True)
    none = pa.nulls(len(again), pa.int64())
    return _rows(none, none, none, none, pa.array(again.view(np.int64)), pa.array(docs.astype(np.int64) + 2))


@dataclass(frozen=True)
class Frequent:
    """Which tokens are frequent: a bit for the high bits of each. None that is frequent is missed, a few others are told so."""

    power: int
    words: np.ndarray  # 64 bits each

    def has(self, tokens: np.ndarray) -> np.ndarray:
        at = tokens >> np.uint64(64 - self.power)
        return (self.words[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _common(scanned: DataFrame) -> Frequent:
    """The tokens of HOT_DOCS documents or more."""
    counted = scanned.filter("token IS NOT NULL").groupBy("token").agg(F.sum("docs").alias("docs"))
    at = F.shiftrightunsigned("token", 64 - MOST_BITS)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), at.bitwiseAND(F.lit(63)).cast("int"))
    words = counted.filter(F.col("docs") >= HOT_DOCS).select(F.shiftrightunsigned(at, 6).alias("word"), bit.alias("bit")).groupBy("word")
    found = words.agg(F.bit_or("bit").alias("bits")).toArrow()  # at most 2^(MOST_BITS - 6) rows
    bits = found["bits"].to_numpy().view(np.uint64)
    places = np.concatenate([found["word"].to_numpy()[(bits >> np.uint64(k)) & np.uint64(1) == 1] * 64 + k for k in range(64)])
    # The table shrinks to what its tokens need.
    power = min(MOST_BITS, max(LEAST_BITS, (BITS * len(places)).bit_length()))
    places = np.unique(places >> (MOST_BITS - power)).astype(np.uint64)
    table_ = np.zeros(1 << (power - 6), np.uint64)
    np.bitwise_or.at(table_, (places >> np.uint64(6)).astype(np.int64), np.uint64(1) << (places & np.uint64(63)))
    return Frequent(power, table_)


def _matched(s: np.ndarray, common: Frequent) -> np.ndarray:
    """The probe tokens of a set: the first ones in the order (frequent, hash)."""
    often = common.has(s)
    if often.any():
        s = np.concatenate([s[~often], s[often]])
    return s[: len(s) - needed(len(s)) + 1]


def _dealt(docs: DataFrame, common: Frequent, buckets: int) -> DataFrame:
    """The tokens to match, dealt to buckets by their high bits: packed (39 low bits of the token and whether it is an index token, node) pairs."""
    shipped = docs.sparkSession.sparkContext.broadcast(common)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw, offsets in slices(batches, "text", SLICE):
            distinct = {_node(s): s for s in sets(raw, offsets) if len(s)}
            if not distinct:
                continue
            parts = [_matched(s, shipped.value) for s in distinct.values()]
            tokens = np.concatenate(parts)
            sizes = [len(x) for x in parts]
            owner = np.repeat(np.fromiter(distinct, np.int64, len(distinct)), sizes)
            index = np.concatenate([np.arange(len(x)) <= len(s) - least_index(len(s)) for x, s in zip(parts, distinct.values(), strict=True)])
            order = np.argsort(tokens, kind="stable")
            tokens, owner, index = tokens[order], owner[order], index[order]
            bucket = ((tokens >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
            edges = np.concatenate([[0], np.flatnonzero(bucket[1:] != bucket[:-1]) + 1, [len(tokens)]])
            low, high = tokens.astype(np.uint32), ((tokens >> np.uint64(32)).astype(np.uint8) & np.uint8(0x7F)) | (index.astype(np.uint8) << np.uint8(7))
            packed = [low[a:b].tobytes() + high[a:b].tobytes() + owner[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(bucket[edges[:-1]], pa.int64()), pa.array(packed, pa.binary())], ["bucket", "packed"])
        release()

    return _texts(docs).filter("doc_id IS NOT NULL").select("text").mapInArrow(run, "bucket long, packed binary")


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows sorted by bucket: (list, size, part, members, index, times) of tokens where classes meet."""
    held: list[bytes] = []
    current = None
    for batch in batches:
        for bucket, packed in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if bucket != current and held:
                yield from _lists(held)
                held = []
            current = bucket
            held.append(packed.as_py())
    if held:
        yield from _lists(held)
    release()


def _lists(held: list[bytes]) -> Iterator[pa.RecordBatch]:
    sizes = [len(x) // 13 for x in held]
    low = np.concatenate([np.frombuffer(x, np.uint32, n) for x, n in zip(held, sizes, strict=True)])
    high = np.concatenate([np.frombuffer(x, np.uint8, n, 4 * n) for x, n in zip(held, sizes, strict=True)])
    ids = np.concatenate([np.frombuffer(x, np.int64, n, 5 * n) for x, n in zip(held, sizes, strict=True)])
    index = high >= 0x80
    tokens = ((high & np.uint8(0x7F)).astype(np.uint64) << np.uint64(32)) | low
    order = np.lexsort((~index, ids, tokens))
    tokens, ids, index = tokens[order], ids[order], index[order]
    once = np.concatenate([[True], (tokens[1:] != tokens[:-1]) | (ids[1:] != ids[:-1])])  # copies met in several slices
    tokens, ids, index = tokens[once], ids[once], index[once]
    start = np.flatnonzero(np.concatenate([[True], tokens[1:] != tokens[:-1]]))
    size = np.diff(np.append(start, len(tokens)))
    key = np.add.reduceat(mix(ids.view(np.uint64) + index.astype(np.uint64)), start)
    met = size > 1
    start, size, key = start[met], size[met], key[met]
    _, first, times = np.unique(key, return_index=True, return_counts=True)
    rows: list[list] = [[], [], [], [], [], []]
    for i, many in zip(first.tolist(), times.tolist(), strict=True):
        end = start[i] + size[i]
        for part, at in enumerate(range(start[i], end, CHUNK)):
            upto = min(at + CHUNK, end)
            for column, value in zip(rows, (int(key[i].view(np.int64)), int(size[i]), part, ids[at:upto], index[at:upto], many), strict=True):
                column.append(value)
    if rows[0]:
        kinds = (pa.int64(), pa.int64(), pa.int32(), _LONGS, pa.list_(pa.bool_()), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(rows, kinds, strict=True)], ["list", "size", "part", "members", "index", "times"])


def _few(frame: DataFrame, rows: int, most: int | None = None) -> DataFrame:
    """A frame of names with its number of rows, marked for a broadcast if it is small."""
    return F.broadcast(frame) if rows <= min(BROADCAST_IDS, BROADCAST_IDS if most is None else most) else frame


def _hashed(docs: DataFrame, wanted: DataFrame, told, kind: str, arrow: pa.DataType) -> DataFrame:
    """(node, tokens) of the classes in ``wanted`` (node, rep), with ``told`` of each set; rows that repeat a class's first id repeat it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, raw, offsets in slices(batches, "text", SLICE):
            found = {_node(s): s for s in sets(raw, offsets) if len(s)}
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array([told(s) for s in found.values()], arrow)], ["node", "tokens"])
        release()

    ids = kept(wanted.select(F.col("rep").alias("__gm_id")).distinct())
    return _texts(docs).join(_few(ids, ids.count()), F.col("doc_id") == F.col("__gm_id"), "left_semi").select("text").mapInArrow(run, f"node long, tokens {kind}").checkpoint()


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, tokens): whole sets."""
    return _hashed(docs, wanted, lambda s: s.view(np.int64), "array<bigint>", _LONGS)


def prints(s: np.ndarray) -> bytes:
    """The high 16 bits of every token of a set, 32 of a large one, in order."""
    kind, shift = (np.uint16, 48) if len(s) <= WIDE else (np.uint32, 32)
    return (s >> np.uint64(shift)).astype(kind).tobytes()


def counted(told: bytes, n: int, wide: bool) -> tuple[np.ndarray, np.ndarray]:
    """(values, times) of the prints of a set of n tokens; narrow ones if they are not asked wide."""
    values = np.frombuffer(told, np.uint32 if len(told) == 4 * n else np.uint16)
    if not wide and values.dtype == np.uint32:
        values = (values >> np.uint32(16)).astype(np.uint16)
    return np.unique(values, return_counts=True)


def union(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The prints of which no member has any more often."""
    if len(parts) == 1:
        return parts[0]
    values, times = np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])
    order = np.lexsort((times, values))
    values, times = values[order], times[order]
    last = np.append(values[1:] != values[:-1], True)
    return values[last], times[last]


def overlap(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """At least the tokens that a set shares with any member of a union."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    return int(np.minimum(a[1][i], b[1][j]).sum())


def _least(a: str, b: str) -> str:
    """SQL for the number of probe tokens that a linked pair of these sizes shares at least."""
    return f"greatest(1L, (4 * ({a} + {b}) + 8) div 9 - (4 * greatest({a}, {b}) + 4) div 5 + 1)"


def _salted(frame: DataFrame, key: str, rows: int = CROWD) -> DataFrame:
    """(key, salts): into how many tasks the rows of a key are dealt."""
    return frame.groupBy(key).agg(F.expr(f"1 + count(1) div {rows}").alias("salts"))


def _leader_links(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """Links (a, b) among ``pairs`` (node, partner); one set is sent to the other, a partner of many is salted."""
    salts = kept(_salted(pairs.select(F.col("partner").alias("b")), "b", 256))
    rows = pairs.count()
    named = pairs.join(side(salts), F.col("partner") == F.col("b")).select(F.col("node").alias("a"), "b", F.expr("pmod(xxhash64(node), salts)").alias("s"))
    asks = held.select(F.col("node").alias("m"), F.col("tokens").alias("x")).join(_few(named, rows, BROADCAST_NAMES), F.col("m") == F.col("a")).select("a", "b", "s", "x")
    leaders = held.select(F.col("node").alias("c"), F.col("tokens").alias("y")).join(_few(salts, rows, BROADCAST_NAMES), F.col("c") == F.col("b")).select("c", "y", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1)).alias("t"))
    both = asks.join(leaders, (F.col("b") == F.col("c")) & (F.col("s") == F.col("t")))
    return both.filter(9 * F.size(F.array_intersect("x", "y")) >= 4 * (F.size("x") + F.size("y"))).select("a", "b")


def listed(docs: DataFrame, common: Frequent) -> DataFrame:
    """(list, size, times, node, index): one row per class and list of classes that meet over a token."""
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = _dealt(docs, common, 16 * partitions).repartition(partitions, "bucket").sortWithinPartitions("bucket")
    found = found.mapInArrow(_listed, "list long, size long, part int, members array<bigint>, index array<boolean>, times long")
    lists = found.groupBy("list", "part").agg(F.first("size").alias("size"), F.first("members").alias("members"), F.first("index").alias("index"), F.sum("times").alias("times"))
    return kept(lists.select("list", "size", "times", F.explode(F.arrays_zip("members", "index")).alias("m")).select("list", "size", "times", F.col("m.members").alias("node"), F.col("m.index").alias("index")))


def partners(members: DataFrame, known: DataFrame) -> DataFrame:
    """(node, rep, partner, partner_rep): each listed class with the one that leads most of its lists, if they share enough to link."""
    heads = known.select(F.col("node").alias("head"), F.col("n").alias("h"), F.col("rep").alias("h_rep"))
    # The head of a list is its member that meets most others: the text that a family of near copies was made from.
    met = members.groupBy("node").agg(F.sum(F.col("times") * F.col("size")).alias("meets"))
    headed = members.join(side(met), "node").groupBy("list").agg(F.max_by("node", F.struct("meets", "node")).alias("head"))
    pairs = members.join(side(headed), "list").filter("node <> head").groupBy("node", "head").agg(F.sum("times").alias("times"))
    sized = pairs.join(side(known), "node").join(side(heads), "head").filter(f"5 * least(n, h) >= 4 * greatest(n, h) AND times >= {_least('n', 'h')}")
    best = sized.groupBy("node", "rep").agg(F.max_by(F.struct("head", "h_rep"), F.struct("times", -F.col("head"))).alias("best"))
    return kept(best.select("node", "rep", F.col("best.head").alias("partner"), F.col("best.h_rep").alias("partner_rep")))


def parted(grouped: DataFrame) -> DataFrame:
    """(node, n, rep, grp, part, docs): the part of its group that a class is in, and how many the group has."""
    sizes = grouped.groupBy(F.col("grp").alias("g")).agg(F.expr(f"1 + (count(1) - 1) div {PART}").alias("parts"), F.count(F.lit(1)).alias("docs"))
    return kept(grouped.join(side(sizes), F.col("grp") == F.col("g")).select("node", "n", "rep", "grp", F.expr("pmod(xxhash64(node), parts)").alias("part"), "docs"))


def contested(members: DataFrame, grouped: DataFrame) -> DataFrame:
    """(list, times, node, n, grp, index, salts): the entries of lists that still have several groups; in no other a class meets a group that is not its own.

    ``grouped`` is (node, n, grp) of all listed classes; if it has the sizes of groups (docs), the entries have them too.
    """
    docs = ["docs"] if "docs" in grouped.columns else []
    rows = members.join(side(grouped.select("node", "n", "grp", *docs)), "node").select("list", "times", "node", "n", "grp", "index", *docs)
    open_ = rows.groupBy("list").agg((F.min("grp") != F.max("grp")).alias("open"), F.expr(f"1 + count(1) div {CROWD}").alias("salts")).filter("open").select("list", "salts")
    return kept(rows.join(side(open_), "list"))


def asked(members: DataFrame, grouped: DataFrame, rows: DataFrame | None = None) -> DataFrame:
    """(node, n, g): the queries, each with a group that it may link with by an index token of the smaller set.

    Rows grow with the ``contested`` entries (``rows``, if they are known), times
    the groups that have the token. With the sizes of groups (docs) only the smaller
    of two groups asks the other, over its own index tokens too; without them each
    document asks the groups whose index tokens it has.
    """
    rows = contested(members, grouped) if rows is None else rows
    sized = "docs" in rows.columns
    of = ["list", "salts", F.col("grp").alias("g"), *([F.col("docs").alias("others")] if sized else [])]
    own = [F.min(F.when(F.col("index"), F.col("n"))).alias("low"), F.max(F.when(F.col("index"), F.col("n"))).alias("high")]
    groups = rows.groupBy(*of).agg(*own, F.min("n").alias("least"), F.max("n").alias("most")).withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("salts") - 1))).drop("salts")
    probes = rows.withColumn("salt", F.expr("pmod(xxhash64(node), salts)")).drop("salts", "times")
    larger = "n >= low AND 4 * n <= 5 * high"  # the document is the larger set of a pair
    if sized:
        larger = f"(docs < others OR docs = others AND grp < g) AND ({larger} OR index AND n <= most AND 4 * least <= 5 * n)"
    return kept(probes.join(side(groups), ["list", "salt"]).filter(f"grp <> g AND {larger}").select("node", "n", "g").distinct())


def qualified(queries: DataFrame, members: DataFrame, grouped: DataFrame) -> DataFrame:
    """(node, n, g, part): the parts whose union has enough of a query's tokens for a link with one of their sizes.

    ``queries`` is (node, n, g), ``members`` (list, times, node) of all lists or of the
    contested ones, ``grouped`` (node, n, rep, grp, part). Only names of lists move here, no sets,
    and of those a hash with the group, beside the number of the query: two that
    collide can only raise a bound.
    """
    key = F.xxhash64("list", "g", "crowd").alias("key")
    crowds = kept(queries.groupBy("g").agg(F.expr(f"1 + count(1) div {CROWD}").alias("crowds")))
    inside = grouped.join(side(crowds), F.col("grp") == F.col("g")).select("node", "n", "g", "part", "crowds")
    sizes = inside.groupBy("g", "part", "crowds").agg(F.min("n").alias("low"), F.max("n").alias("high"))
    union = members.select("list", "times", "node").join(side(inside.select("node", "g", "part", "crowds")), "node").select("list", "times", "g", "part", "crowds").distinct()
    union = union.select("list", "times", "g", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("crowds") - 1)).alias("crowd")).select(key, "times", "part")
    numbered = kept(queries.join(side(crowds), "g").select("node", "n", "g", F.expr("pmod(xxhash64(node), crowds)").alias("crowd"), F.monotonically_increasing_id().alias("pair")))
    asks = numbered.join(side(members.select("list", F.col("node").alias("m"))), F.col("node") == F.col("m")).select(key, "pair")
    counts = asks.join(side(union), "key").groupBy("pair", "part").agg(F.sum("times").alias("bound")).join(side(numbered.select("pair", "node", "n", "g")), "pair")
    sized = counts.join(side(sizes.drop("crowds")), ["g", "part"]).withColumn("lo", F.expr("greatest(low, (4 * n + 4) div 5)")).withColumn("hi", F.expr("least(high, (5 * n) div 4)"))
    # What a link needs rises with the other size up to n and then falls, but for rounding, which repeats every nine sizes.
    ends = ", ".join(_least("n", x) for x in ("lo", *(f"greatest(lo, hi - {k})" for k in range(9))))
    return kept(sized.filter(f"lo <= hi AND bound >= least({ends})").select("node", "n", "g", "part"))


def _opened(key: tuple[pa.Scalar, ...], queries: pa.Table, members: pa.Table) -> pa.Table:
    """The first link of each query among the documents of one part."""
    a, b = [], []
    if queries.num_rows and members.num_rows:
        own = [np.asarray(x.values, np.int64) for x in members.column("tokens")]
        ids = members.column("node").to_pylist()
        for query, tokens in zip(queries.column("node").to_pylist(), queries.column("tokens"), strict=True):
            mine = np.asarray(tokens.values, np.int64)
            for other, theirs in zip(ids, own, strict=True):
                if 5 * min(len(mine), len(theirs)) >= 4 * max(len(mine), len(theirs)):
                    shared = len(np.intersect1d(mine, theirs, assume_unique=True))
                    if 9 * shared >= 4 * (len(mine) + len(theirs)):
                        a.append(query)
                        b.append(other)
                        break
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64()), "g": pa.array([key[0].as_py()] * len(a), pa.int64())})


def _bounded(key: tuple[pa.Scalar, ...], queries: pa.Table, members: pa.Table) -> pa.Table:
    """(node, n, g, part, bound) of the queries that may share enough of their sets with the union of a part."""
    out: list[tuple[int, int, int]] = []
    held = {w: None for w in (False, True)}
    told = [(t.as_py(), n) for t, n in zip(members.column("tokens"), members.column("n").to_pylist(), strict=True)]
    all_wide = bool(told) and all(len(t) == 4 * n for t, n in told)
    for node, n, tokens in zip(queries.column("node").to_pylist(), queries.column("n").to_pylist(), queries.column("tokens"), strict=True):
        mine = tokens.as_py()
        wide = all_wide and len(mine) == 4 * n
        if told and held[wide] is None:
            held[wide] = union([counted(t, m, wide) for t, m in told])
        if told and (bound := overlap(counted(mine, n, wide), held[wide])) >= needed(n):
            out.append((node, n, bound))
    g, part = key[0].as_py(), key[1].as_py()
    columns = [[x[0] for x in out], [x[1] for x in out], [g] * len(out), [part] * len(out), [x[2] for x in out]]
    return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("node", "n", "g", "part", "bound"), columns, strict=True)})


def _met(pairs: DataFrame, grouped: DataFrame, tokens: DataFrame, run, schema: str) -> DataFrame:
    """What ``run`` finds between the queries and the members of each part, of ``pairs`` (node, n, g, part); parts with many queries are salted."""
    crowds = kept(pairs.groupBy("g", "part").agg(F.expr("1 + count(1) div 256").alias("crowds")))
    key = ["g", "part", "crowd"]
    asks = pairs.join(side(crowds), ["g", "part"]).select("node", "n", "g", "part", F.expr("pmod(xxhash64(node), crowds)").alias("crowd"))
    there = grouped.select("node", "n", F.col("grp").alias("g"), "part").join(side(crowds), ["g", "part"]).select("node", "n", "g", "part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("crowds") - 1)).alias("crowd"))

    def sent(rows: DataFrame):
        rows = kept(rows)
        held = tokens.select(F.col("node").alias("m"), F.col("tokens").alias("tokens"))
        return held.join(_few(rows, rows.count(), BROADCAST_NAMES), F.col("m") == F.col("node")).select(*[F.col(c).alias(c) for c in (*key, "node", "n")], "tokens").groupBy(*key)  # names of its own for each side

    return kept(sent(asks).cogroup(sent(there)).applyInArrow(run, schema))


def _named(found: DataFrame, grouped: DataFrame) -> DataFrame:
    """(node, rep) of the queries and of the members of the parts in ``found`` (node, g, part)."""
    parts = found.select("g", F.col("part").alias("p")).distinct()
    members = grouped.join(side(parts), (F.col("grp") == F.col("g")) & (F.col("part") == F.col("p")), "left_semi").select("node", "rep")
    return grouped.select("node", "rep").join(side(found.select(F.col("node").alias("m")).distinct()), F.col("node") == F.col("m"), "left_semi").union(members)


def group_links(docs: DataFrame, queries: DataFrame, members: DataFrame, grouped: DataFrame) -> DataFrame:
    """Links (a, b) between groups: the best part of each asked group first, then the others."""
    found = qualified(queries, members, grouped)
    frames.release(docs.sparkSession)
    told = _hashed(docs, _named(found, grouped), prints, "binary", pa.binary())
    found = _met(found, grouped, told, _bounded, "node long, n long, g long, part long, bound long")
    frames.release(docs.sparkSession)
    held = _sets(docs, _named(found, grouped))
    best = kept(found.groupBy("node", "n", "g").agg(F.max_by("part", F.struct("bound", "part")).alias("part")))
    first = _met(best, grouped, held, _opened, "a long, b long, g long")
    frames.release(docs.sparkSession)
    done = first.select(F.col("a").alias("node"), "g")
    rest = kept(found.select("node", "n", "g", "part").join(side(best), ["node", "g", "part"], "left_anti").join(side(done), ["node", "g"], "left_anti"))
    if rest.isEmpty():
        return first.select("a", "b")
    return first.union(_met(rest, grouped, held, _opened, "a long, b long, g long")).select("a", "b")


def classes(docs: DataFrame) -> tuple[DataFrame, DataFrame, Frequent]:
    """(doc_id, row_key, n, node) of all rows, (node, n, rep) of all classes, and the frequent tokens."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), row_key().alias("row_key"))
    scanned = rows.mapInArrow(_scanned, "doc_id long, row_key long, n long, node long, token long, docs long").checkpoint()
    named = scanned.filter("token IS NULL").select("doc_id", "row_key", "n", "node")
    reps = named.filter("node IS NOT NULL").groupBy("node").agg(F.first("n").alias("n"), F.min("doc_id").alias("rep"))
    return named, reps, _common(scanned)


def groups(docs: DataFrame, members: DataFrame, known: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Links (a, b) with partners, and (node, n, rep, grp, part) of all listed classes by these links."""
    pairs = partners(members, known)
    frames.release(docs.sparkSession)
    held = _sets(docs, pairs.select("node", "rep").union(pairs.select("partner", "partner_rep")))
    first = kept(_leader_links(held, pairs.select("node", "partner")))
    labels = components(first).withColumnRenamed("node", "__gm_node")
    return first, parted(known.join(side(labels), F.col("node") == F.col("__gm_node"), "left").select("node", "n", "rep", F.coalesce("label", "node").alias("grp")))


def links(docs: DataFrame, reps: DataFrame, common: Frequent) -> DataFrame:
    """Links (a, b) between classes, enough to connect every linked pair."""
    members = listed(docs, common)
    frames.release(docs.sparkSession)
    known = kept(reps.join(side(members.select("node").distinct()), "node", "left_semi"))
    first, grouped = groups(docs, members, known)
    frames.release(docs.sparkSession)
    rows = contested(members, grouped)
    queries = asked(members, grouped, rows)
    frames.release(docs.sparkSession)
    return kept(first.union(group_links(docs, queries, rows, grouped)))


def _joined(docs: DataFrame) -> DataFrame:
    """(doc_id, row_key, n, label, component_id) of every row; the label is a set of the component."""
    ensure_checkpoint_dir(docs.sparkSession)
    named, reps, common = classes(docs)
    labels = components(links(docs, reps, common)).withColumnRenamed("node", "__gm_node")
    linked = reps.join(side(labels), F.col("node") == F.col("__gm_node")).select("node", "rep", "label")
    linked = kept(linked)
    smallest = linked.groupBy(F.col("label").alias("l")).agg(F.min("rep").alias("component_id"))
    of = linked.join(side(smallest), F.col("label") == F.col("l")).select(F.col("node").alias("c"), "component_id", "label")
    classed = reps.select(F.col("node").alias("m"), "rep").join(side(of), F.col("m") == F.col("c"), "left")
    joined = named.join(classed.select("m", F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("label", "m").alias("label")), F.col("node") == F.col("m"), "left")
    return joined.select("doc_id", "row_key", "n", "label", F.coalesce("component_id", "doc_id").alias("component_id"))


def join(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id for every row of ``docs`` (doc_id, text)."""
    return _joined(docs).select("doc_id", F.col("n").alias("n_shingles"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each component one row with the smallest id stays.

    Rows are told apart by id and text, so an id that is repeated with unlike
    texts keeps a row for each component. A row without an id stays only in a
    component without ids. Rows without any words link with nothing and stay.
    Texts are not shuffled while the rows to drop are few.
    """
    found = _joined(docs).filter("n > 0").checkpoint()
    first = found.groupBy(F.col("label").alias("c")).agg(F.min_by("row_key", F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("kept"))
    named = found.select("row_key", "label").join(first, F.col("label") == F.col("c"))
    drop = named.filter("row_key <> kept").select(F.col("row_key").alias("__gm_key")).distinct()
    drop = kept(drop)
    twice = kept(named.filter("row_key = kept").groupBy("row_key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1").select(F.col("row_key").alias("__gm_key")))
    keyed = docs.withColumn("__gm_row", row_key())
    rest = keyed.join(_few(drop, drop.count()), F.col("__gm_row") == F.col("__gm_key"), "left_anti")
    if twice.isEmpty():
        return rest.drop("__gm_row")
    side = _few(twice, twice.count())
    single = rest.join(side, F.col("__gm_row") == F.col("__gm_key"), "left_semi").dropDuplicates(["__gm_row"])
    return rest.join(side, F.col("__gm_row") == F.col("__gm_key"), "left_anti").unionByName(single).drop("__gm_row")


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of every document under the shingle similarity of four fifths."""
    return join(table(spark, sf_dir, "documents"))
