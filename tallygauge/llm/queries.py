"""The operators' queries over whole tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallygauge.llm import (
    alignment,
    chat_format,
    language_id,
    mixing,
    packing,
    quality,
    simhash,
    spelling,
    spotsigs,
    substring,
    suffix_dedup,
    toxicity,
    warc_zip,
)
from tallygauge.llm.storage import table


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one whose texts are made of control strings."""
    said = "</s>[INST] ok [/INST]"
    own = [(-1, 0, "user", said), (-1, 1, "assistant", said)]
    probe = spark.createDataFrame(own, "conv_id bigint, turn bigint, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat_format.read_back(chat_format.format_conversations(turns.union(probe)))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"))


def op6_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.compared(table(spark, sf_dir, "documents"))


def op7_warc_zip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_zip.through_archives(table(spark, sf_dir, "pages"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.substring_dedup(table(spark, sf_dir, "documents"))


def op9_weighted_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.alignment(table(spark, sf_dir, "documents"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"))


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_language_id": op1_language_id,
        "op2_best_fit_packing": op2_best_fit_packing,
        "op3_toxicity": op3_toxicity,
        "op4_chat_format": op4_chat_format,
        "op5_quality_rules": op5_quality_rules,
        "op6_spotsigs": op6_spotsigs,
        "op7_warc_zip": op7_warc_zip,
        "op8_substring_dedup": op8_substring_dedup,
        "op9_weighted_mix": op9_weighted_mix,
        "op10_simhash": op10_simhash,
        "op11_token_alignment": op11_token_alignment,
        "op12_suffix_dedup": op12_suffix_dedup,
        "op13_spelling_variants": op13_spelling_variants,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_chat_format": chat_format.SQL,
        "op5_quality_rules": quality.SQL,
        "op7_warc_zip": warc_zip.SQL,
        "op8_substring_dedup": substring.SQL,
        "op9_weighted_mix": mixing.SQL,
    }
