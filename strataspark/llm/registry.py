"""Queries of this package by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strataspark.llm import ann, chat, clusters, lm_score, mixing, ngram_join, packing, phrases, quality, substring_dedup, topk, toxicity, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ann": ann.op1_ann,
    "op2_packing": packing.op2_packing,
    "op3_mixing": mixing.op3_mixing,
    "op4_substring_dedup": substring_dedup.op4_substring_dedup,
    "op5_topk": topk.op5_topk,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_chat_format": chat.op8_chat_format,
    "op9_lm_score": lm_score.op9_lm_score,
    "op10_ngram_join": ngram_join.op10_ngram_join,
    "op11_quality": quality.op11_quality,
    "op12_clusters": clusters.op12_clusters,
    "op13_phrases": phrases.op13_phrases,
}

ORACLE_SQL: dict[str, str] = {
    "op4_substring_dedup": substring_dedup.SQL,
    "op5_topk": topk.SQL,
    "op7_url_filter": url_filter.SQL,
    "op8_chat_format": chat.SQL,
    "op10_ngram_join": ngram_join.SQL,
    "op12_clusters": clusters.SQL,
    "op13_phrases": phrases.SQL,
}
