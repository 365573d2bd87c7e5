import random
import zlib

import numpy as np
import pytest

from gleanmill.llm import language_id as lid
from tests.conftest import DATA


def test_held_out_accuracy(spark):
    out = lid.op5_language_id(spark, DATA).join(spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert len(out) == 200
    kept = [r for r in out if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in out)
    assert sum(r.lang == r.lang_pred for r in kept) >= 0.97 * len(kept) and all(0 <= r.score <= 1 for r in out)


def test_edges(spark, edge, empty):
    model = lid.fit(spark.read.parquet(f"{DATA}/documents.parquet"))
    assert (model.weights == 0).mean() > 0.5
    told = {r.doc_id: r for r in lid.predict(edge, model).collect()}
    assert all(told[i].lang_pred == "und" and told[i].score == 0 for i in (4, 5, 10, 11))
    assert (told[1].lang_pred, told[1].score) == (told[2].lang_pred, told[2].score)
    assert lid.predict(empty, model).count() == 0
    nothing = lid.fit(empty)
    assert {r.lang_pred for r in lid.predict(edge, nothing).collect()} == {"und"}
    assert lid.fit(edge).languages in (("en",), ("en", "fr"))


def made(n, seed=5):
    """Sparse rows of three languages whose grams overlap: (language, buckets, counts)."""
    rng = random.Random(seed)
    out = []
    for i in range(n):
        lang = "abc"[i % 3]
        own = {rng.randrange(0, 30) + 20 * (i % 3) for _ in range(12)} | {rng.randrange(0, 90) for _ in range(4)}
        buckets = np.array(sorted(own), np.int64)
        out.append((lang, buckets, np.array([float(rng.randint(1, 4)) for _ in buckets])))
    return out


def test_training_against_plain_loops(monkeypatch):
    """The update by its definition, one weight at a time, and the temperature by trying all."""
    monkeypatch.setattr(lid, "BUCKETS", 90)
    rows, idf = made(40), np.linspace(0.5, 2.0, 90)
    model = lid.train(rows, idf)
    z, n = {}, {}
    fit = [r for i, r in enumerate(rows) if i % 5 != 4]
    order = np.random.default_rng(11)

    def weight(key):
        if abs(z.get(key, 0.0)) <= lid.L1:
            return 0.0
        return -(z[key] - np.sign(z[key]) * lid.L1) / ((lid.BETA + np.sqrt(n[key])) / lid.ALPHA + lid.L2)

    def vector(buckets, counts):
        raw = [(1 + np.log(c)) * idf[b] for b, c in zip(buckets, counts, strict=True)]
        length = np.sqrt(sum(v * v for v in raw))
        return [*((int(b), v / length) for b, v in zip(buckets, raw, strict=True)), (90, 1.0)]

    for _ in range(lid.EPOCHS):
        for i in order.permutation(len(fit)):
            lang, buckets, counts = fit[i]
            x = vector(buckets, counts)
            w = {(j, k): weight((j, k)) for j, _ in x for k in range(3)}
            s = [sum(v * w[j, k] for j, v in x) for k in range(3)]
            p = np.exp(np.array(s) - max(s))
            p /= p.sum()
            for j, v in x:
                for k in range(3):
                    g = v * (p[k] - ("abc"[k] == lang))
                    old = n.get((j, k), 0.0)
                    z[j, k] = z.get((j, k), 0.0) + g - (np.sqrt(old + g * g) - np.sqrt(old)) / lid.ALPHA * w[j, k]
                    n[j, k] = old + g * g
    for j in range(90):
        for k in range(3):
            assert abs(model.weights[j, k] - (weight((j, k)) if (j, k) in z else 0.0)) < 1e-9
    assert (model.weights == 0).any() and model.languages == ("a", "b", "c")


def test_temperature_calibrates(monkeypatch):
    """On rows that were kept apart the temperature makes the truth no less likely, and less confident where the model errs."""
    monkeypatch.setattr(lid, "BUCKETS", 90)
    rows = made(400)
    rng = random.Random(2)
    noisy = [(rng.choice("abc") if rng.random() < 0.3 else lang, b, c) for lang, b, c in rows]
    model = lid.train(noisy, np.ones(90))
    kept = [r for i, r in enumerate(noisy) if i % 5 == 4]

    def loss(t):
        total = 0.0
        for lang, b, c in kept:
            s = model.logits(b, c) / t
            total += np.log(np.exp(s - s.max()).sum()) + s.max() - s["abc".index(lang)]
        return total / len(kept)

    assert loss(model.temperature) <= loss(1.0) + 1e-6 and loss(model.temperature) <= min(loss(0.1), loss(10.0))


def test_document_frequencies(spark):
    rows = [(4, "ab ab", "x"), (8, "ab cd", "x"), (16, "", "x"), (20, None, "y"), (None, "ab", "y")]
    data = spark.createDataFrame([r for r in rows if r[0] is None or zlib.crc32(str(r[0]).encode()) % 4 != 2], "doc_id long, text string, lang string")
    used = [r for r in data.collect() if r.doc_id is not None and r.text is not None]
    model = lid.fit(data)
    df = np.zeros(lid.BUCKETS)
    for r in used:
        raw = r.text.encode()
        for b, _ in lid.grams(np.frombuffer(raw, np.uint8), np.array([0, len(raw)])):
            df[b] += 1
    assert np.allclose(model.idf, np.log((1 + len(used)) / (1 + df)) + 1)


def test_a_row_repeated_very_often_counts_once(spark, monkeypatch):
    from pyspark.sql import functions as F

    collected = []
    train = lid.train
    monkeypatch.setattr(lid, "train", lambda rows, idf: collected.append(len(rows)) or train(rows, idf))
    few = spark.createDataFrame([(i, f"words of text {i}", "xy"[i % 2]) for i in range(40)], "doc_id long, text string, lang string")
    often = spark.range(100_000).select(F.lit(3).cast("long").alias("doc_id"), F.lit("the same words again").alias("text"), F.lit("x").alias("lang"))
    lid.fit(few.union(often), sample_rows=200_000)
    assert collected and collected[0] <= 41
    lid.fit(few, sample_rows=4)
    assert collected[1] <= 8


def test_very_long_texts(spark):
    long = "das ist ein Text mit vielen Worten " * 60_000
    rows = [(i, long if i == 4 else "das ist ein kurzer Text" if i % 2 else "this is a short text", "de" if i % 2 or i == 4 else "en") for i in range(60)] + [(4, long, "de")] * 3
    data = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = lid.fit(data)
    told = {r.doc_id: r.lang_pred for r in lid.predict(data, model).collect()}
    assert told[4] == "de" and told[8] == "en" and lid.predict(data, model).count() == len(rows)


@pytest.mark.parametrize("ids", ["one", "many"])
def test_copies_take_no_room_from_other_texts(spark, ids):
    """One text is nearly the whole table and far more rows than the sample takes; all others are told as without it."""
    from pyspark.sql import functions as F

    r = np.random.default_rng(8)
    words = {"en": "the and of that with this from have been which were their would there".split(), "de": "der und die das mit ist ein nicht auf eine wird auch nach werden".split()}
    rows = [(i, " ".join(r.choice(words[k], 12)), k) for i in range(400) for k in (("en", "de")[i % 2],)]
    few = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    often = spark.range(60_000).select((F.lit(3) if ids == "one" else F.col("id") + 1000).cast("long").alias("doc_id"), F.lit("one english text that is repeated").alias("text"), F.lit("en").alias("lang"))
    model = lid.fit(few.union(often).repartition(6), sample_rows=100)
    told = {x.doc_id: x.lang_pred for x in lid.predict(few, model).collect()}
    assert [i for i, _, k in rows if told[i] != k] == []


def test_a_text_under_two_languages(spark):
    rows = [(i, f"plain words {i % 7}", ("en", "de")[i % 2]) for i in range(60)]
    data = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert lid.fit(data) is not None and {x.lang_pred for x in lid.predict(data.repartition(3), lid.fit(data.repartition(5))).collect()} <= {"en", "de"}
