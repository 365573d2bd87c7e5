"""Unique file names: a name that is taken goes on to _2, _3 and so on until one is free.

Rows take names in the order of their positions: the row's own name if no earlier
row and no existing file has it, else the first free number from 2. Rows of one
name only meet rows of other names where a name itself ends in a number: ``a_2``
is the own name of one group and the second choice of the group ``a``. Which of
the two gets it depends on who comes first, so these clashes, and no others, are
settled in a loop to a fixed point:

* A clash (group, number) is on if the group has to pass the number over. The
  rows of a group pass over the clashes that are on, so the r-th row arrives at
  number k if k - r clashes below k are on.
* A clash with another group's own name is on if the arriving row comes later
  than that group's first row. Otherwise it takes the name, and the other
  group's own name is passed over there.
* A clash with an existing file is always on.

A clash depends only on clashes of smaller numbers and of groups with fewer
endings, so the loop ends and has one result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gleanmill.operators.ordered import ranked, running

#: A name that may be a numbered one: its beginning, and a number from 2 without leading zeros.
NUMBERED = r"^(.*)_([2-9]|[1-9][0-9]{1,8})$"


def _beginning(stem: Column) -> Column:
    return F.when(stem.rlike(NUMBERED), F.regexp_extract(stem, NUMBERED, 1))


def _number(stem: Column) -> Column:
    return F.when(stem.rlike(NUMBERED), F.regexp_extract(stem, NUMBERED, 2).cast("long"))


def unique_names(rows: DataFrame, stem: str, suffix: str, pos: str, existing: DataFrame | None = None) -> DataFrame:
    """Rows with ``unique_name``; ``existing`` has (stem, suffix) of files that are there already.

    A suffix starts at the last dot of a name or is empty. Positions are unique.
    Null stems and suffixes are empty ones.
    """
    own = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"__gm_{c}") for c in (stem, suffix)]
    keys = ["__gm_stem", "__gm_suffix"]
    rows = rows.select("*", own[0].alias(keys[0]), own[1].alias(keys[1]))
    placed = ranked(rows, keys, pos, "__gm_r").checkpoint()
    arriving = placed.select(*[F.col(k).alias(f"{k}_a") for k in keys], F.col("__gm_r").alias("__gm_i"), F.col(pos).alias("__gm_p"))
    clashes = _clashes(placed, keys, pos, existing).checkpoint()
    if clashes.isEmpty():
        return _named(placed.withColumn("__gm_shift", F.lit(0)), keys)
    clashes = _settled(clashes, arriving, keys)
    # A row passes over the clashes that are on and that no later row arrives at.
    passed = clashes.filter("on").select(*keys, F.struct(F.col("i").alias("x"), F.lit(0).alias("row"), F.col("k").alias("y")).alias("__gm_at"), F.lit(1).alias("__gm_v"))
    some = passed.select(*keys).distinct()
    moved = placed.join(some, keys, "left_semi").select(*keys, F.struct(F.col("__gm_r").alias("x"), F.lit(1).alias("row"), F.lit(0).cast("long").alias("y")).alias("__gm_at"), F.lit(0).alias("__gm_v"))
    shifts = running(passed.unionByName(moved), keys, "__gm_at", F.col("__gm_v"), "__gm_shift").filter("__gm_at.row = 1 AND __gm_shift > 0").select(*keys, F.col("__gm_at.x").alias("__gm_r"), "__gm_shift")
    return _named(placed.join(shifts, [*keys, "__gm_r"], "left"), keys)


def _named(rows: DataFrame, keys: list[str]) -> DataFrame:
    n = F.col("__gm_r") + F.coalesce("__gm_shift", F.lit(0))
    name = F.concat(F.col(keys[0]), F.when(n > 1, F.concat(F.lit("_"), n.cast("string"))).otherwise(F.lit("")), F.col(keys[1]))
    return rows.withColumn("unique_name", name).drop(*keys, "__gm_r", "__gm_shift")


def _clashes(placed: DataFrame, keys: list[str], pos: str, existing: DataFrame | None) -> DataFrame:
    """(keys, k, kind, first, other): numbers that a group may have to pass over."""
    groups = placed.groupBy(*keys).agg(F.min(pos).alias("first"))
    child = groups.select(F.col(keys[0]).alias("other"), _beginning(F.col(keys[0])).alias(keys[0]), F.col(keys[1]), _number(F.col(keys[0])).alias("k"), "first").filter("k IS NOT NULL")
    child = child.join(groups.select(*keys), keys, "left_semi").checkpoint()
    none = F.lit(None)
    base = child.select(F.col("other").alias(keys[0]), keys[1], F.lit(1).cast("long").alias("k"), F.lit("own").alias("kind"), none.cast(child.schema["first"].dataType).alias("first"), none.cast("string").alias("other"))
    out = child.select(*keys, "k", F.lit("other").alias("kind"), "first", "other").unionByName(base)
    if existing is None:
        return out
    files = existing.select(*[F.coalesce(c, F.lit("")).alias(k) for c, k in zip(("stem", "suffix"), keys, strict=True)]).distinct()
    taken = files.select(*keys, F.lit(1).cast("long").alias("k")).unionByName(files.select(_beginning(F.col(keys[0])).alias(keys[0]), keys[1], _number(F.col(keys[0])).alias("k")).filter("k IS NOT NULL"))
    taken = taken.join(groups.select(*keys), keys, "left_semi").select(*keys, "k", F.lit("file").alias("kind"), *[none.cast(out.schema[c].dataType).alias(c) for c in ("first", "other")])
    return out.join(taken, [*keys, "k"], "left_anti").unionByName(taken)


def _settled(clashes: DataFrame, arriving: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, k, i, on): the clashes once none changes any more; i is the row that arrives."""
    state = clashes.withColumn("on", F.col("kind") != "own")
    while True:
        counted = running(state, keys, "k", F.col("on").cast("long"), "below", before=True).withColumn("i", F.col("k") - F.col("below"))
        met = [F.col(k) == F.col(f"{k}_a") for k in keys] + [F.col("i") == F.col("__gm_i")]
        told = counted.join(arriving, met, "left")
        later = F.coalesce(F.col("__gm_p") > F.col("first"), F.lit(False))
        told = told.select(*keys, "k", "kind", "first", "other", "on", "i", F.when(F.col("kind") == "other", later).when(F.col("kind") == "file", F.lit(True)).alias("next"), F.coalesce(F.col("__gm_p") < F.col("first"), F.lit(False)).alias("takes")).checkpoint()
        lost = told.filter("kind = 'other' AND takes").select(F.col("other").alias(keys[0]), keys[1], F.lit("own").alias("kind"), F.lit(True).alias("lost"))
        new = told.join(lost, [*keys, "kind"], "left").withColumn("next", F.coalesce("next", "lost", F.lit(False))).drop("lost", "takes").checkpoint()
        if new.filter("on <> next").isEmpty():
            return new.select(*keys, "k", "i", "on")
        state = new.withColumn("on", F.col("next")).drop("next", "i")
