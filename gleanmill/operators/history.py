"""Anti-joins with a large history: a Bloom filter first, the exact join for what is left.

The filter is built where the history is read: each key sets ``BITS`` bits of one
64-bit word, and words are merged by a bitwise aggregate that combines before the
shuffle. It never misses a key of the history. Rows whose word lacks a bit are surely
new and go on without a shuffle; only the others meet the history.

The filter has at most ``WORDS`` words, whatever the history, and is broadcast. A
history beyond some eight keys a word fills it, so that more rows take the exact way;
no result depends on that. Words are grouped in ``BUCKETS`` by the leading bits of a key's hash, so a
kept filter can be merged with that of new keys bucket by bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Words of a filter at most (8 bytes each, some 50 as a broadcast row), bits that a key sets, buckets of words.
WORDS = 1 << 20
BITS = 4
BUCKETS = 64
#: Keys a word that a filter is sized for.
LOAD = 6


def words_for(keys: int, most: int = WORDS) -> int:
    """Words for a history of about so many keys: a power of two."""
    need = max(BUCKETS, keys // LOAD)
    return min(most, 1 << (need - 1).bit_length())


def _word(key: Column, words: int) -> Column:
    return F.shiftrightunsigned(F.xxhash64(key), 64 - (words - 1).bit_length()).cast("int")


def _mask(key: Column) -> Column:
    """The bits of a key in its word, from a second hash."""
    hash_ = F.xxhash64(F.lit(7), key)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(hash_, 6 * i).bitwiseAND(F.lit(63)).cast("int")) for i in range(BITS)]
    out = bits[0]
    for b in bits[1:]:
        out = out.bitwiseOR(b)
    return out


def build(history: DataFrame, key: str, words: int) -> DataFrame:
    """(bucket, word, bits) of the keys of a history; null keys are none. ``words`` is a power of two."""
    keyed = history.filter(F.col(key).isNotNull()).select(_word(F.col(key), words).alias("word"), _mask(F.col(key)).alias("bits"))
    return _merged(keyed.withColumn("bucket", (F.col("word") / (words // BUCKETS)).cast("int")))


def _merged(parts: DataFrame) -> DataFrame:
    return parts.groupBy("bucket", "word").agg(F.bit_or("bits").alias("bits"))


def merge(*filters: DataFrame) -> DataFrame:
    """One filter for the keys of several histories; all have the same number of words."""
    out = filters[0]
    for f in filters[1:]:
        out = out.unionByName(f)
    return _merged(out)


def marked(rows: DataFrame, key: str, bloom: DataFrame, words: int, name: str = "maybe_seen") -> DataFrame:
    """Rows with a flag that is false only if the key is surely not in the history; a null key is not in it."""
    spread = bloom.select(F.col("word").alias("__gm_word"), F.col("bits").alias("__gm_bits"))  # at most ``words`` rows
    joined = rows.withColumn("__gm_at", _word(F.col(key), words)).join(F.broadcast(spread), F.col("__gm_at") == F.col("__gm_word"), "left")
    mask = _mask(F.col(key))
    hit = F.col("__gm_bits").isNotNull() & F.col(key).isNotNull() & (F.col("__gm_bits").bitwiseAND(mask) == mask)
    return joined.withColumn(name, F.coalesce(hit, F.lit(False))).drop("__gm_at", "__gm_word", "__gm_bits")


def unseen(rows: DataFrame, key: str, history: DataFrame, words: int | None = None, bloom: DataFrame | None = None) -> DataFrame:
    """Rows whose key the history (a frame with a column of the same name) does not have; rows with a null key stay.

    The filter may be given with its number of words, if it is kept beside the history; it
    must hold all keys of the history and may hold more.
    """
    if words is None:
        words = words_for(history.count())
    told = marked(rows, key, bloom if bloom is not None else build(history, key, words), words)
    new = told.filter("NOT maybe_seen").drop("maybe_seen")
    asked = told.filter("maybe_seen").drop("maybe_seen")
    known = history.select(key).filter(F.col(key).isNotNull()).distinct()
    # The history is asked for these keys alone.
    return new.unionByName(asked.join(known.hint("shuffle_merge"), key, "left_anti"))
