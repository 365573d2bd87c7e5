"""A training corpus from documents in five stages, each one operator.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
and read again as the next one's docs. All but the last return the columns of
``documents``.

1. quality_rules: documents that fail a base rule or a certified cutoff go.
2. ngram_join: of each component of near duplicates the smallest id stays.
3. pii_boosting: personal data is replaced by its kind; n_chars is counted anew.
4. pfair_mixing: the rows are put into the order of the mix of their sources.
5. byte_bpe: token counts and digests of the ids and of the decoded text.

Nulls, empty texts, ties, repeated rows and empty tables have the results that
the operators define; a null or empty text has fewer than 50 words and goes in
the first stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gleanmill.llm import byte_bpe, ngram_join, pfair_mixing, pii_boosting, quality_rules
from gleanmill.session import ensure_checkpoint_dir, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; cutoffs come from the labels beside the documents."""
    return quality_rules.keep_good(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return ngram_join.one_of_each(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without personal data in their texts."""
    return pii_boosting.redact(docs).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mix."""
    return pfair_mixing.interleave(docs)


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of all documents."""
    return byte_bpe.digests(docs)


STAGES = [
    ("quality_rules", quality),
    ("ngram_join", near_duplicates),
    ("pii_boosting", personal_data),
    ("pfair_mixing", mixing),
    ("byte_bpe", encoding),
]

#: Merge replay, boosted trees and the similarity join have no SQL form; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is checkpointed before the next."""
    ensure_checkpoint_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).checkpoint()
    return STAGES[-1][1](spark, docs, sf_dir)
