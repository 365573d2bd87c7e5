"""Queries over whole tables: nothing of the input is left out."""

from pyspark.sql import functions as F

from gleanmill.plans import catalog
from tests.conftest import DATA


def test_every_document_is_in_a_list(spark):
    listed = catalog.QUERIES["string_agg_all"](spark, DATA).select(F.explode(F.split("docs", ", ").cast("array<bigint>")).alias("doc_id"))
    ids = sorted(r.doc_id for r in spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id").collect())
    assert sorted(r.doc_id for r in listed.collect()) == ids


def test_every_document_has_a_number(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    assert docs.select("lang").distinct().count() > 1
    got = catalog.QUERIES["global_numbers_all"](spark, DATA).orderBy("doc_id").collect()
    assert [r.n for r in got] == list(range(1, docs.count() + 1))


def test_history_is_a_whole_state(spark):
    orders, lines = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("orders", "lineitem"))
    returned = {r[0] for r in lines.filter("l_returnflag = 'R'").select("l_orderkey").collect()}
    assert len(returned) > 100
    left = {r[0] for r in orders.select("o_orderkey").collect()} - returned
    assert left and {r[0] for r in catalog.QUERIES["state_antijoin_orders"](spark, DATA).collect()} == left
