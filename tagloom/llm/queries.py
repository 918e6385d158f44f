"""One query per operator of this subpackage, over the given tables, and their comparison SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tagloom.llm import (
    conversations, decontaminate, html_extract, jaccard_tree, packing, phrases, quality, secrets, sharding, token_counts, toxicity, warc,
    window_packing,
)
from tagloom.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def op1_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf, "documents"), read(spark, sf, "labels"))


def op2_warc_revisits(spark: SparkSession, sf: str) -> DataFrame:
    return warc.revisit_digest(read(spark, sf, "pages"))


def op3_jaccard_tree_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_tree.jaccard_components(read(spark, sf, "documents"))


def op4_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(read(spark, sf, "documents"))


def op5_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.count_tokens(read(spark, sf, "documents"))


def op6_balanced_sharding(spark: SparkSession, sf: str) -> DataFrame:
    return sharding.shard_documents(read(spark, sf, "documents"))


def op7_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    return secrets.secrets_digest(read(spark, sf, "documents"))


def op8_host_quality(spark: SparkSession, sf: str) -> DataFrame:
    return quality.quality(read(spark, sf, "documents"))


def op9_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontaminate.contamination(read(spark, sf, "documents"), read(spark, sf, "benchmark"))


def op10_main_text(spark: SparkSession, sf: str) -> DataFrame:
    return html_extract.main_text(read(spark, sf, "pages"))


def op11_phrases(spark: SparkSession, sf: str) -> DataFrame:
    return phrases.mine_phrases(read(spark, sf, "documents"))


def op12_window_packing(spark: SparkSession, sf: str) -> DataFrame:
    return window_packing.pack_documents(read(spark, sf, "documents"))


def op13_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    return conversations.repair(read(spark, sf, "conversations"))


QUERIES: dict[str, Query] = {
    q.__name__: q
    for q in (
        op1_toxicity, op2_warc_revisits, op3_jaccard_tree_join, op4_best_fit_packing, op5_token_counts,
        op6_balanced_sharding, op7_secret_scan, op8_host_quality, op9_decontamination, op10_main_text,
        op11_phrases, op12_window_packing, op13_conversation_repair,
    )
}
ORACLES: dict[str, str] = {
    "op2_warc_revisits": warc.ORACLE,
    "op8_host_quality": quality.ORACLE,
    "op9_decontamination": decontaminate.ORACLE,
    "op11_phrases": phrases.ORACLE,
}
