"""Exact histogram of encoded lengths; suffix sums answer questions about every context limit.

Documents are counted by length where they are read, so the shuffle carries one
row per distinct length and task. The running sums are taken in two levels:
inside blocks of ``BLOCK`` lengths, and over the blocks, whose number grows with
the longest text and not with the number of documents. No task sees all lengths.

Defined results: null and empty texts have length 0 and are counted; an empty
table gives an empty histogram; repeated rows count each time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from gleanmill.llm.byte_bpe import encode
from gleanmill.session import ensure_checkpoint_dir, table

BLOCK = 2048


def histogram(lengths: DataFrame, column: str = "n_tokens") -> DataFrame:
    """(length, n_docs) of a frame with one encoded length per document."""
    return lengths.groupBy(F.col(column).alias("length")).agg(F.count(F.lit(1)).alias("n_docs"))


def context_limits(counts: DataFrame) -> DataFrame:
    """For every occurring length, taken as a context limit, exact totals.

    docs_upto and tokens_upto count documents no longer than the limit,
    docs_longer the others; tokens_truncated is the total with every document
    cut at the limit, tokens_lost what the cut loses; permille is the share of
    documents, in thousandths rounded up, that fit whole, so the q-quantile of
    the length is the first limit with permille >= 1000 * q.
    """
    rows = counts.withColumn("block", F.floor(F.col("length") / BLOCK)).withColumn("tokens", F.col("length") * F.col("n_docs"))
    whole = rows.groupBy("block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    after = Window.orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    blocks = whole.select(
        "block",
        F.coalesce(F.sum("b_docs").over(after), F.lit(0)).alias("later_docs"),
        F.coalesce(F.sum("b_tokens").over(after), F.lit(0)).alias("later_tokens"),
        F.sum("b_docs").over(every).alias("docs_total"),
        F.sum("b_tokens").over(every).alias("tokens_total"),
    )
    longer = Window.partitionBy("block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    summed = (
        rows.join(blocks, "block")
        .withColumn("docs_longer", F.col("later_docs") + F.coalesce(F.sum("n_docs").over(longer), F.lit(0)))
        .withColumn("tokens_longer", F.col("later_tokens") + F.coalesce(F.sum("tokens").over(longer), F.lit(0)))
    )
    return summed.select(
        F.col("length").alias("context_limit"),
        "n_docs",
        (F.col("docs_total") - F.col("docs_longer")).alias("docs_upto"),
        "docs_longer",
        (F.col("tokens_total") - F.col("tokens_longer")).alias("tokens_upto"),
        (F.col("tokens_total") - F.col("tokens_longer") + F.col("docs_longer") * F.col("length")).alias("tokens_truncated"),
        (F.col("tokens_longer") - F.col("docs_longer") * F.col("length")).alias("tokens_lost"),
        F.expr("((docs_total - docs_longer) * 1000 + docs_total - 1) div docs_total").alias("permille"),
        "docs_total",
        "tokens_total",
    )


def at_limits(limits: DataFrame, asked: list[int]) -> DataFrame:
    """(context_limit, docs_upto, tokens_truncated) for any limits, occurring or not.

    Answered from the nearest occurring length below: no document has a length
    between the two, so only the part of the longer documents grows.
    """
    wanted = limits.sparkSession.range(1).select(F.explode(F.array(*[F.lit(int(x)) for x in asked]).cast("array<bigint>")).alias("asked"))
    nearest = (
        limits.join(F.broadcast(wanted), F.col("context_limit") <= F.col("asked"), "right")  # as many rows as limits were asked
        .groupBy("asked")
        .agg(F.max_by(F.struct("context_limit", "docs_upto", "docs_longer", "tokens_truncated"), "context_limit").alias("x"))
    )
    total = limits.agg(F.max("docs_total").alias("docs_total"))
    return nearest.join(F.broadcast(total)).select(
        F.col("asked").alias("context_limit"),
        F.coalesce(F.col("x.docs_upto"), F.lit(0)).alias("docs_upto"),
        F.coalesce(
            F.col("x.tokens_truncated") + F.col("x.docs_longer") * (F.col("asked") - F.col("x.context_limit")),
            F.col("docs_total") * F.col("asked"),
            F.lit(0),
        ).alias("tokens_truncated"),
    )


def op10_token_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals for every context limit over all documents, by the ids of the byte-level BPE."""
    ensure_checkpoint_dir(spark)
    # Both levels of the sums use the histogram: it is written once, so that no text is encoded again.
    counts = histogram(encode(table(spark, sf_dir, "documents"), with_ids=False)).checkpoint()
    return context_limits(counts)
