"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Lower-cased letters and single blanks give n-grams of one to three signs, hashed
to ``BUCKETS`` dimensions. Document frequencies come from all documents that may
be learned from. The weights are trained by follow-the-regularised-leader with
elastic-net penalties (L1 leaves most weights at zero) on a sample of at most
twice ``SAMPLE_ROWS`` different texts, spread evenly over the languages by a hash of
the text. What share of a language is drawn follows from its number of different
texts, so a text of which there are many copies counts once and takes no room
from others; every fifth sampled text is kept apart and sets the temperature of the softmax.

Only rows with a language whose crc32(doc_id as text) mod 4 is not 2 are learned
from; a prediction uses nothing but the text. The model has a fixed size
(dimensions times languages) and is broadcast.

Defined results: a null text or one without a letter is ``und`` with score 0, as
is everything when there is nothing to learn from; equal texts get equal
predictions; ties go to the first language in alphabetical order; a null id is
neither held out nor learned from; a text that stands under two languages counts once for each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.llm.arrow_text import release, slices
from gleanmill.llm.byte_bpe import LETTER, classes
from gleanmill.session import table

BUCKETS = 1 << 15
SAMPLE_ROWS = 4000
EPOCHS = 2
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.05, 0.5
_SHIFT = np.uint32(32 - 15)
_MIX = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
_LETTERS: list[np.ndarray] = []


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == 2, F.lit(False))


def grams(raw: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(buckets, counts) of each text; no buckets for a text without letters."""
    if not _LETTERS:
        _LETTERS.append(classes() == LETTER)
    data = raw.tobytes()
    for start, stop in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        points = np.frombuffer(data[start:stop].decode("utf-8").lower().encode("utf-32-le"), np.uint32)
        letter = _LETTERS[0][points]
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # of what stands between words one blank stays
        if not letter.any():
            yield np.zeros(0, np.int64), np.zeros(0, np.int64)
            continue
        signs = np.where(letter, points, np.uint32(32))[keep] + np.uint32(1)
        one = signs * _MIX[0]
        keys = [one]
        if len(signs) > 1:
            two = (one[:-1] ^ (one[:-1] >> np.uint32(15))) * _MIX[1] + signs[1:] * _MIX[2]
            keys.append(two)
            if len(signs) > 2:
                keys.append((two[:-1] ^ (two[:-1] >> np.uint32(13))) * _MIX[0] + signs[2:] * _MIX[1] + np.uint32(7))
        mixed = np.concatenate(keys)
        mixed = ((mixed ^ (mixed >> np.uint32(16))) * _MIX[1]) >> _SHIFT
        counts = np.bincount(mixed, minlength=BUCKETS)
        buckets = np.flatnonzero(counts)
        yield buckets, counts[buckets]


@dataclass(frozen=True)
class Model:
    languages: tuple[str, ...]
    idf: np.ndarray
    weights: np.ndarray  # buckets x languages
    bias: np.ndarray
    temperature: float

    def vector(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        value = (1 + np.log(counts)) * self.idf[buckets]
        return value / np.sqrt((value**2).sum())

    def logits(self, buckets: np.ndarray, counts: np.ndarray) -> np.ndarray:
        return self.vector(buckets, counts) @ self.weights[buckets] + self.bias

    def predict(self, buckets: np.ndarray, counts: np.ndarray) -> tuple[str, float]:
        if not len(buckets) or not self.languages:
            return "und", 0.0
        z = self.logits(buckets, counts) / self.temperature
        p = np.exp(z - z.max())
        best = int(np.argmax(z))
        return self.languages[best], float(p[best] / p.sum())


def train(rows: list[tuple[str, np.ndarray, np.ndarray]], idf: np.ndarray) -> Model:
    """FTRL-proximal with elastic net over (language, buckets, counts), then temperature scaling.

    The order of the rows is part of the result: callers pass them sorted.
    """
    languages = tuple(sorted({x[0] for x in rows}))
    k = len(languages)
    blank = Model(languages, idf, np.zeros((BUCKETS, k)), np.zeros(k), 1.0)
    if k < 2:
        return blank
    z, n = np.zeros((BUCKETS + 1, k)), np.zeros((BUCKETS + 1, k))  # the last row is the bias

    def solve(zz: np.ndarray, nn: np.ndarray) -> np.ndarray:
        return np.where(np.abs(zz) > L1, -(zz - np.sign(zz) * L1) / ((BETA + np.sqrt(nn)) / ALPHA + L2), 0.0)

    number = {x: i for i, x in enumerate(languages)}
    fit = [x for i, x in enumerate(rows) if i % 5 != 4 or len(rows) < 10]
    kept = [x for i, x in enumerate(rows) if i % 5 == 4] or rows
    made = [(number[lang], np.append(b, BUCKETS), np.append(blank.vector(b, c), 1.0)) for lang, b, c in fit]
    order = np.random.default_rng(11)
    for _ in range(EPOCHS):
        for i in order.permutation(len(made)):
            lang, at, value = made[i]
            zz, nn = z[at], n[at]
            w = solve(zz, nn)
            s = value @ w
            p = np.exp(s - s.max())
            p /= p.sum()
            p[lang] -= 1
            g = value[:, None] * p[None, :]
            z[at] = zz + g - (np.sqrt(nn + g * g) - np.sqrt(nn)) / ALPHA * w
            n[at] = nn + g * g
    w = solve(z, n)
    model = Model(languages, idf, w[:-1], w[-1], 1.0)
    logits = np.array([model.logits(b, c) for _, b, c in kept])
    truth = np.array([number[lang] for lang, _, _ in kept])
    doubt = 1 / (len(kept) + 2)  # smoothed targets: rows that are all told apart would ask for no temperature at all

    def loss(t: float) -> float:
        s = logits / t
        top = s.max(1)
        told = (1 - doubt) * s[np.arange(len(s)), truth] + doubt * s.mean(1)
        return float((top + np.log(np.exp(s - top[:, None]).sum(1)) - told).mean())

    temperature = min(np.geomspace(0.05, 10, 120).tolist(), key=loss)
    return Model(languages, idf, w[:-1], w[-1], temperature)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, docs) over a task's rows; bucket -1 counts the rows."""
    docs, rows = np.zeros(BUCKETS, np.int64), 0
    for _, raw, offsets in slices(batches, "text"):
        for buckets, _ in grams(raw, offsets):
            docs[buckets] += 1
            rows += 1
    some = np.flatnonzero(docs)
    release()
    yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(docs[some], rows))], ["bucket", "docs"])


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, raw, offsets in slices(batches, "text"):
        found = list(grams(raw, offsets))
        columns = [pa.array([x.astype("<i4").tobytes() for x in part], pa.binary()) for part in zip(*found, strict=True)]
        yield pa.RecordBatch.from_arrays([rows.column(0), rows.column(1), *columns], ["doc_id", "lang", "buckets", "counts"])


def fit(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Train on ``docs`` (doc_id, text, lang): frequencies from all eligible rows, weights from the sample."""
    eligible = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    eligible = eligible.filter(F.col("doc_id").isNotNull() & F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    frequency = eligible.select("text").mapInArrow(_counted, "bucket long, docs long").groupBy("bucket").agg(F.sum("docs").alias("docs"))
    found = {int(r[0]): int(r[1]) for r in frequency.collect()}  # one row per bucket
    total = found.pop(-1, 0)
    df = np.zeros(BUCKETS)
    df[list(found)] = list(found.values())
    idf = np.log((1 + total) / (1 + df)) + 1
    keyed = eligible.withColumn("key", F.xxhash64("text"))
    sizes = keyed.select("lang", "key").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    n_languages = F.count(F.lit(1)).over(_whole())
    share = sizes.select(F.col("lang").alias("l"), F.least(F.lit(1.0), F.lit(float(sample_rows)) / n_languages / F.col("n")).alias("share"))  # one row per language
    unit = F.pmod("key", F.lit(1 << 30)) / F.lit(float(1 << 30))
    drawn = keyed.join(F.broadcast(share), F.col("lang") == F.col("l")).filter(unit < F.col("share"))
    # Copies fold where they are read; the bound holds however the hashes fall.
    once = drawn.groupBy("key", "lang").agg(F.min("doc_id").alias("doc_id"), F.first("text").alias("text"))
    chosen = once.orderBy("key", "lang").limit(2 * sample_rows).select("doc_id", "lang", "text")
    rows = chosen.mapInArrow(_sparse, "doc_id long, lang string, buckets binary, counts binary").collect()
    rows = [(r["doc_id"], r["lang"], np.frombuffer(r["buckets"], "<i4").astype(np.int64), np.frombuffer(r["counts"], "<i4").astype(np.float64)) for r in rows if r["buckets"]]
    rows.sort(key=lambda r: (r[0], r[1], r[2].tobytes(), r[3].tobytes()))
    return train([r[1:] for r in rows], idf)


def _whole():
    from pyspark.sql import Window

    return Window.partitionBy()


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred, score of every row."""
    shipped = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, raw, offsets in slices(batches, "text"):
            told = [shipped.value.predict(b, c) for b, c in grams(raw, offsets)]
            yield pa.RecordBatch.from_arrays([rows.column(0), pa.array([t[0] for t in told], pa.string()), pa.array([t[1] for t in told], pa.float64())], ["doc_id", "lang_pred", "score"])
        release()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, lang_pred string, score double")


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by a model learned from three quarters of them."""
    docs = table(spark, sf_dir, "documents")
    return predict(docs, fit(docs)).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
