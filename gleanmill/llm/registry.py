"""Queries of this subpackage and their SQL, for the driver's entry point."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from gleanmill.llm import byte_bpe, embedding_whitening, language_id, ngram_join, noisy_channel, ogg_media, pfair_mixing, pii_boosting, quality_rules, reply_trees, stamp_times, token_histogram, wrapper_induction


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_ogg_media": ogg_media.op1_ogg_media,
        "op2_pfair_mixing": pfair_mixing.op2_pfair_mixing,
        "op3_pii_boosting": pii_boosting.op3_pii_boosting,
        "op4_byte_bpe": byte_bpe.op4_byte_bpe,
        "op5_language_id": language_id.op5_language_id,
        "op6_ngram_join": ngram_join.op6_ngram_join,
        "op7_wrapper_induction": wrapper_induction.op7_wrapper_induction,
        "op8_quality_rules": quality_rules.op8_quality_rules,
        "op9_reply_trees": reply_trees.op9_reply_trees,
        "op10_token_histogram": token_histogram.op10_token_histogram,
        "op11_noisy_channel": noisy_channel.op11_noisy_channel,
        "op12_timestamp_normalisation": stamp_times.op12_timestamp_normalisation,
        "op13_embedding_whitening": embedding_whitening.op13_embedding_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_pfair_mixing": pfair_mixing.ORACLE_SQL,
        "op8_quality_rules": quality_rules.ORACLE_SQL,
        "op9_reply_trees": reply_trees.ORACLE_SQL,
        "op12_timestamp_normalisation": stamp_times.ORACLE_SQL,
    }
