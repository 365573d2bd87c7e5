"""The pipeline against brute force on a small fixture, and the registry."""

import hashlib
import random

import numpy as np

import __spark_entry__
import corpus_pipeline
from gleanmill.llm import pii_boosting
from tests.llm.test_byte_bpe import known  # noqa: F401
from tests.llm.test_ngram_join import brute


def corpus():
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    docs = []
    for i in range(40):
        words = [word() for _ in range(rng.choice((10, 60, 90)))]
        if i % 4 == 1:
            words[3:3] = ["bob@mail.example.com", "+1 (743) 555-3824"]
        docs.append(" ".join(words))
    docs += [docs[1], docs[2] + " tail", "", None, " ".join(["same same same"] * 40)]
    return [(i, t, "en", f"s{i % 3}", None if t is None else len(t)) for i, t in enumerate(docs)]


def test_stages(spark, tmp_path, known):  # noqa: F811
    _, library = known
    rows = corpus()
    folder = str(tmp_path)
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{folder}/documents.parquet")
    spark.sql("SELECT * FROM (VALUES (0L, 1, 0), (1L, 1, 0)) AS t(doc_id, quality, toxic)").write.parquet(f"{folder}/labels.parquet")

    def good(text):
        words = (text or "").split()
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        covered = {i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)}
        return len(words) >= 50 and 100 * len(covered) <= 50 * len(words)

    kept = [(d, t) for d, t, *_ in rows if good(t)]
    kept = [(d, t) for d, t in kept if any(d == c and d == k for d2, _, c in brute(kept) for k in [d2] if d2 == d)]
    model = pii_boosting.trained()
    clean = {d: pii_boosting.redacted(t, pii_boosting.spans_of([t], model)[0]) for d, t in kept}
    expected = {
        (d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest())
        for d, t in clean.items()
        for ids in [library.encode_ordinary(t)]
    }
    got = corpus_pipeline.run(spark, folder).collect()
    assert {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got} == expected and len(got) == len(expected)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, folder)
        assert name == "byte_bpe" or docs.schema.names == before.schema.names
        docs.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if name == "pii_boosting":
            assert docs.filter("text LIKE '%@%'").count() == 0 and docs.filter("n_chars <> char_length(text)").count() == 0


def test_registered():
    names = __spark_entry__.queries()
    assert "pipeline" in names and {int(n[2:].split("_")[0]) for n in names if n.startswith("op") and n[2].isdigit()} == set(range(1, 14))


def test_mixing_stage_orders_the_rows(spark, tmp_path):
    from gleanmill.llm import pfair_mixing

    docs = spark.createDataFrame([(i, f"t {i}", "en", f"s{i % 7 % 3}", 3) for i in range(200)], "doc_id long, text string, lang string, source string, n_chars long")
    stage = dict(corpus_pipeline.STAGES)["pfair_mixing"]
    stage(spark, docs, "").write.parquet(f"{tmp_path}/mixed")
    files = sorted((tmp_path / "mixed").glob("part-*.parquet"))
    read = [r.doc_id for f in files for r in spark.read.parquet(str(f)).collect()]
    places = {r.doc_id: r.position for r in pfair_mixing.mix(docs).select("row.doc_id", "position").collect()}
    assert [places[i] for i in read] == list(range(200)) and read != sorted(read)


def written(spark, folder, docs, labels, extra=""):
    schema = "doc_id long, text string, lang string, source string, n_chars long" + extra
    spark.createDataFrame(docs, schema).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")


def test_empty_tables(spark, tmp_path):
    written(spark, tmp_path, [], [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_nulls_repeated_ids_and_other_columns(spark, tmp_path):
    """Nulls in any column, an id with two texts, copies under one id, and columns that operators use by name inside."""
    words = lambda k: " ".join(f"{k}{i}" for i in range(70))
    more = ("b", 1, "k", [1], 7)
    docs = [
        (1, words("a"), "en", "s", 1), (1, words("b"), None, None, None), (1, words("a"), "en", "s", 1), (None, words("c"), "en", "s", 1), (2, words("c"), "en", "s", 1),
        (None, words("d"), None, None, None), (3, None, None, None, None), (4, "", "", "", 0), (5, words("e") + " x@mail.example.com", "en", "t", 5), (6, "e " * 300_000 + words("f"), "en", "t", 6),
    ]
    written(spark, tmp_path, [(*d, *more) for d in docs], [(1, 1, 0), (None, 1, 0), (2, None, None), (2, 1, 1), (99, 1, 0)], ", `rank` string, block int, key string, tokens array<int>, position int")
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in out) == [(False, 1), (False, 1), (False, 2), (False, 5), (True, 0)]
    table = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = table
    for name, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == table.columns, name
    assert "[EMAIL]" in kept.filter("doc_id = 5").first().text
