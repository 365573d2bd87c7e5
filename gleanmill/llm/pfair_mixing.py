"""Mixing sources to target weights by Pfair scheduling (DataFrame and SQL functions only).

The rows of each source are cut into blocks of ``block_rows``. A source with
integer weight e out of a sum of P owes its i-th block (from 1) the window from
release floor((i - 1) * P / e) to deadline ceil(i * P / e). Slots take one block
each; of the released blocks the one with the earliest deadline goes first, ties
by source. So after t slots a source has had t * e / P blocks with a deviation
below one. When a source has no blocks left, a new phase begins for the others,
with the same weights and times counted from its start; no row is dropped or
repeated.

A phase's schedule repeats every P slots, so one fold over at most P slots per
phase, and no more than the phase has, gives all of it, however many blocks there
are. Sources of equal weight have equal windows and go in turn, so a slot looks at
the different weights only, of which there are at most ``resolution``. The folds are SQL expressions
over one row that holds an array element per source. P is at most ``resolution``
times the number of sources. Rows are numbered inside (source, hash bucket)
pairs, 4,096 buckets a source, and offsets of buckets are summed on the counts,
so that no task sees a whole source.

Defined results: a null source is a source of its own; inside a source rows come
in the order of the md5 of their id, then of the id, those without an id by their
other columns; rows with equal ids are all
kept, in any order among themselves; an empty table gives an empty mix; extra
columns stay where the whole row is asked for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanmill.session import ensure_checkpoint_dir, table

BLOCK_ROWS = 16
RESOLUTION = 32
#: Sources are numbered below this.
MOST_SOURCES = 1 << 20
#: With more sources than this the schedule is joined by a shuffle instead of a broadcast.
BROADCAST_SOURCES = 256
SALTS = 32

#: Slots that are put together before they join the others, so that no fold copies a long list for each of its elements.
CHUNK = 128

#: One slot: the released source with the earliest deadline. Sources of one weight have the same windows, so they go in turn, and
#: a state holds of each weight (cw: weights, mem: their sources) how many blocks it had, and of its next block the release and
#: the deadline with the source's number in one long. Only the weight that gets the slot is worked out anew.
_SLOT = f"""
  transform(array(array_min(transform(st.rel, (r, k) -> if(r <= t, st.key[k], NULL))) % {MOST_SOURCES}L), b ->
  transform(array(int(array_position(cw, e[int(b)]) - 1)), at ->
  transform(array((st.done[at] + 1L) div size(mem[at])), i ->
    named_struct(
      'done', transform(st.done, (c, k) -> if(k = at, c + 1L, c)),
      'rel', transform(st.rel, (r, k) -> if(k = at, (i * p) div cw[at], r)),
      'key', transform(st.key, (d, k) -> if(k = at, (((i + 1) * p + cw[at] - 1) div cw[at]) * {MOST_SOURCES}L + mem[at][int((st.done[at] + 1L) % size(mem[at]))], d)),
      'slots', array_append(st.slots, int(b)))
  )[0])[0])[0]
"""

#: The source of each of the first ``n`` slots of a period.
_PERIOD = f"""
  aggregate(sequence(0L, (n - 1L) div {CHUNK}L), named_struct('done', transform(cw, w -> 0L), 'rel', transform(cw, w -> 0L), 'key', transform(cw, (w, k) -> ((p + w - 1) div w) * {MOST_SOURCES}L + mem[k][0]), 'slots', cast(array() AS array<array<int>>)),
    (all, q) -> transform(array(aggregate(sequence(q * {CHUNK}L, least(n, (q + 1L) * {CHUNK}L) - 1L), named_struct('done', all.done, 'rel', all.rel, 'key', all.key, 'slots', cast(array() AS array<int>)), (st, t) -> {_SLOT})),
      more -> named_struct('done', more.done, 'rel', more.rel, 'key', more.key, 'slots', array_append(all.slots, more.slots)))[0],
    all -> flatten(all.slots))
"""

#: The slots of each source: those of its weight in turn; none for sources that are done.
_OWN = """
  transform(array_sort(concat(
    flatten(transform(cw, (w, k) -> transform(array(filter(sequence(0, size(slots) - 1), i -> e[slots[i]] = w)), list ->
      transform(mem[k], (s, j) -> named_struct('s', s, 'own', if(j < size(list), transform(sequence(j, size(list) - 1, size(mem[k])), i -> list[i]), cast(array() AS array<int>)))))[0])),
    transform(filter(sequence(0, size(e) - 1), s -> e[s] = 0L), s -> named_struct('s', s, 'own', cast(array() AS array<int>)))
  )), x -> x.own)
"""

#: What one phase adds. Its length is the first time at which a source has no blocks left. That is known to lie before the
#: earliest deadline of any source's last block, so no more slots than these are worked out, and no more than a period.
_STEP = f"""
  transform(array(transform(weights, (w, s) -> if(ph.rest[s] > 0, w, 0L))), e ->
  transform(array(aggregate(e, 0L, (a, w) -> a + w)), p ->
  transform(array(least(p, array_min(transform(e, (w, s) -> if(w > 0, (ph.rest[s] * p + w - 1L) div w, NULL))))), n ->
  transform(array(array_sort(array_distinct(filter(e, w -> w > 0)))), cw ->
  transform(array(transform(cw, w -> filter(sequence(0, size(e) - 1), s -> e[s] = w))), mem ->
  transform(array({_PERIOD}), slots ->
  transform(array({_OWN}), own ->
  transform(array(array_min(transform(e, (w, s) -> if(w > 0, ((ph.rest[s] - 1) div w) * p + get(own[s], int((ph.rest[s] - 1) % w)) + 1L, NULL)))), len ->
    named_struct('len', len, 'period', p, 'weights', e, 'own', own, 'had', transform(e, (w, s) -> (len div p) * w + size(filter(own[s], i -> i < len % p))))
    )[0])[0])[0])[0])[0])[0])[0])[0]
"""

_PHASE = f"""
  transform(array({_STEP}), x -> named_struct(
      'rest', zip_with(ph.rest, x.had, (r, h) -> r - h),
      'used', zip_with(ph.used, x.had, (r, h) -> r + h),
      'start', ph.start + x.len,
      'phases', array_append(ph.phases, named_struct('start', ph.start, 'period', x.period, 'weights', x.weights, 'own', x.own, 'first', ph.used, 'had', x.had))
    ))[0]
"""

_PHASES = f"""
  aggregate(weights, named_struct('rest', blocks, 'used', transform(blocks, b -> 0L), 'start', 0L,
      'phases', cast(array() AS array<struct<start:bigint,period:bigint,weights:array<bigint>,own:array<array<int>>,first:array<bigint>,had:array<bigint>>>)),
    (ph, w) -> if(forall(ph.rest, r -> r <= 0), ph, {_PHASE}), ph -> ph.phases)
"""


def _once(sql: str) -> Column:
    """A generator of one row: expressions above it don't take the value in and work it out again for each element."""
    return F.explode(F.array(F.expr(sql)))


def source_key(column: str = "source") -> Column:
    """A key that tells a null source from an empty one."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit("null"))


def root_weights(n_rows: Column, most: Column, resolution: int = RESOLUTION) -> Column:
    """Weights in proportion to the square root of the rows, ``resolution`` for the largest source."""
    return F.greatest(F.lit(1).cast("long"), F.floor(F.sqrt(n_rows.cast("double")) / F.sqrt(most.cast("double")) * resolution + 0.5).cast("long"))


def schedule(counts: DataFrame, block_rows: int = BLOCK_ROWS, weights: dict[str, int] | None = None, resolution: int = RESOLUTION) -> DataFrame:
    """(key, phases) per source from (key, n_rows).

    ``weights`` are integers by key (1 where a source isn't named); without
    them the square-root rule holds. A phase has its first slot, period, weight,
    the source's slots in a period, its first block, its number of blocks, and the
    rows that last blocks of earlier phases lack.
    """
    every = Window.partitionBy()
    if weights is None:
        weight = root_weights(F.col("n_rows"), F.max("n_rows").over(every), resolution)
    else:
        given = F.create_map(*[x for k, w in weights.items() for x in (F.lit(k), F.lit(int(w)).cast("long"))]) if weights else F.lit(None).cast("map<string,bigint>")
        weight = F.greatest(F.lit(1).cast("long"), F.coalesce(F.try_element_at(given, "key"), F.lit(1).cast("long")))
    rows = counts.withColumn("weight", weight).withColumn("blocks", F.expr(f"(n_rows + {block_rows - 1}) div {block_rows}"))
    one = rows.agg(F.sort_array(F.collect_list(F.struct("key", "n_rows", "weight", "blocks"))).alias("s"))  # one element per source
    one = one.select("s", F.expr("transform(s, x -> x.weight)").alias("weights"), F.expr("transform(s, x -> x.blocks)").alias("blocks"))
    planned = one.select("s", _once(_PHASES).alias("ph"))
    # Each source gets its own part of the phases before rows are made of them.
    parts = _once(f"""transform(s, (x, i) -> struct(x.key AS key, x.blocks * {block_rows} - x.n_rows AS missing,
      transform(filter(numbers, q -> ph[q].had[i] > 0), q -> struct(q AS q, ph[q].start AS start, ph[q].period AS period, ph[q].weights[i] AS weight, ph[q].own[i] AS own, ph[q].first[i] AS first, ph[q].had[i] AS had)) AS phases))""")
    last = "transform(slice(x.phases, -1, 1), p -> p.start + ((p.had - 1) div p.weight) * p.period + p.own[int((p.had - 1) % p.weight)])[0]"
    planned = planned.select("s", "ph", F.expr("transform(ph, (p, q) -> q)").alias("numbers"), F.expr("transform(ph, p -> p.start)").alias("starts"))
    parted = planned.select("starts", parts.alias("parts"))
    ends = parted.select("starts", "parts", _once(f"transform(parts, x -> struct({last} AS slot, x.missing AS missing))").alias("ends"))
    # A phase ends with the last block of a source, so what such blocks lack is the same for all slots of a phase.
    gaps = ends.select("parts", _once("transform(starts, b -> aggregate(filter(ends, e -> e.slot < b), 0L, (a, e) -> a + e.missing))").alias("gaps"))
    told = "transform(parts, x -> struct(x.key AS key, transform(x.phases, p -> struct(p.start AS start, p.period AS period, p.weight AS weight, p.own AS own, p.first AS first, p.had AS had, gaps[p.q] AS gap)) AS phases))"
    return gaps.select(F.explode(F.expr(told)).alias("x")).select("x.*")


def mix(rows: DataFrame, id_column: str = "doc_id", source_column: str = "source", block_rows: int = BLOCK_ROWS, weights: dict[str, int] | None = None, resolution: int = RESOLUTION) -> DataFrame:
    """(row, key, block, slot, release, deadline, position): every row with its place in the mix.

    ``row`` is a struct of the columns of ``rows``. Positions count from 0 without gaps.
    """
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    ensure_checkpoint_dir(rows.sparkSession)
    # Rows without an id are told apart by what they hold, so that they are no hot key.
    digest = F.md5(F.coalesce(F.col(id_column).cast("string"), F.concat(F.lit("null"), F.xxhash64(*[F.col(f"`{c}`").cast("string") for c in rows.columns if c != id_column]).cast("string"))))
    keyed = rows.select(whole.alias("row"), source_key(source_column).alias("key"), digest.alias("digest")).withColumn("bucket", F.substring("digest", 1, 3))
    buckets = rows.select(source_key(source_column).alias("key"), F.substring(digest, 1, 3).alias("bucket")).groupBy("key", "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = buckets.select("key", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    counts = buckets.groupBy("key").agg(F.sum("n").alias("n_rows"))
    # The plan is one row over all sources, worked out in one task: it is written once.
    plan = schedule(counts, block_rows, weights, resolution).checkpoint()
    order = Window.partitionBy("key", "bucket").orderBy("digest", F.col(f"row.`{id_column}`"))
    numbered = keyed.withColumn("rn", F.row_number().over(order)).join(offsets, ["key", "bucket"])
    numbered = numbered.select("row", "key", (F.col("offset") + F.col("rn") - 1).alias("nth")).withColumn("block", F.expr(f"nth div {block_rows}"))
    if plan.count() <= BROADCAST_SOURCES:
        joined = numbered.join(F.broadcast(plan), "key")
    else:  # a source with many rows is spread over salts
        salted = plan.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = numbered.withColumn("salt", F.pmod("block", F.lit(SALTS)).cast("int")).join(salted, ["key", "salt"])
    placed = joined.select(
        "row", "key", "nth", "block",
        F.expr("filter(phases, p -> block >= p.first AND block < p.first + p.had)[0]").alias("p"),
    ).withColumn("j", F.expr("block - p.first"))
    return placed.select(
        "row", "key", "block",
        F.expr("p.start + (j div p.weight) * p.period + p.own[int(j % p.weight)]").alias("slot"),
        F.expr("p.start + (j * p.period) div p.weight").alias("release"),
        F.expr("p.start + ((j + 1) * p.period + p.weight - 1) div p.weight").alias("deadline"),
        (F.expr("p.start + (j div p.weight) * p.period + p.own[int(j % p.weight)]") * block_rows - F.col("p.gap") + F.col("nth") % block_rows).alias("position"),
    )


def interleave(rows: DataFrame, id_column: str = "doc_id", source_column: str = "source", block_rows: int = BLOCK_ROWS, weights: dict[str, int] | None = None) -> DataFrame:
    """``rows``, all of them, in the order of the mix: a range sort, so that written files follow it."""
    mixed = mix(rows, id_column, source_column, block_rows, weights)
    return mixed.orderBy("position").select("row.*")


def op2_pfair_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place of every document in the mix, with weights by the square-root rule."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mix(docs).select("row.doc_id", F.col("key").alias("source_key"), "block", "slot", "release", "deadline", "position")


#: The same mix by stepping through the slots one at a time.
ORACLE_SQL = f"""
WITH RECURSIVE named AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'null' ELSE '=' || source END AS key FROM documents
), numbered AS (
  SELECT doc_id, key, row_number() OVER (PARTITION BY key ORDER BY md5(coalesce(doc_id::VARCHAR, 'null')), doc_id NULLS FIRST) - 1 AS nth FROM named
), counted AS (
  SELECT key, count(*) AS n, greatest(1, floor(sqrt(count(*)::DOUBLE) / sqrt((max(count(*)) OVER ())::DOUBLE) * {RESOLUTION} + 0.5)::BIGINT) AS w FROM named GROUP BY key
), start AS (
  SELECT list(key ORDER BY key) AS keys, list(w ORDER BY key) AS w, list(((n + {BLOCK_ROWS - 1}) // {BLOCK_ROWS})::BIGINT ORDER BY key) AS blocks FROM counted
), steps AS (
  SELECT -1::BIGINT AS slot, 0::BIGINT AS t, 0::BIGINT AS began, keys, w, blocks AS rest, list_transform(w, lambda x: 0::BIGINT) AS done, list_transform(w, lambda x: 0::BIGINT) AS used,
         0::BIGINT AS pick, 0::BIGINT AS release, 0::BIGINT AS deadline, 0::BIGINT AS block
  FROM start WHERE len(w) > 0
  UNION ALL
  SELECT slot + 1, CASE WHEN rest[b] = 1 THEN 0 ELSE t + 1 END, CASE WHEN rest[b] = 1 THEN slot + 2 ELSE began END, keys, w,
         list_transform(rest, lambda x, i: CASE WHEN i = b THEN x - 1 ELSE x END),
         list_transform(done, lambda x, i: CASE WHEN rest[b] = 1 THEN 0 WHEN i = b THEN x + 1 ELSE x END),
         list_transform(used, lambda x, i: CASE WHEN i = b THEN x + 1 ELSE x END),
         b, began + (done[b] * p) // w[b], began + ((done[b] + 1) * p + w[b] - 1) // w[b], used[b]
  FROM (
    SELECT *, list_min(list_filter(list_transform(w, lambda x, i: CASE WHEN rest[i] > 0 AND (done[i] * p) // x <= t THEN (((done[i] + 1) * p + x - 1) // x) * 1000000 + i END), lambda x: x IS NOT NULL)) % 1000000 AS b
    FROM (SELECT *, list_sum(list_transform(w, lambda x, i: CASE WHEN rest[i] > 0 THEN x ELSE 0 END))::BIGINT AS p FROM steps)
    WHERE p > 0
  )
), placed AS (
  SELECT n.doc_id, n.key, n.nth, s.block, s.slot, s.release, s.deadline
  FROM steps s JOIN numbered n ON s.slot >= 0 AND n.key = s.keys[s.pick] AND n.nth // {BLOCK_ROWS} = s.block
)
SELECT doc_id, key AS source_key, block::BIGINT AS block, slot::BIGINT AS slot, release::BIGINT AS release, deadline::BIGINT AS deadline,
       row_number() OVER (ORDER BY slot, nth) - 1 AS position
FROM placed
"""
