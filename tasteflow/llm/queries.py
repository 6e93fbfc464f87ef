"""Queries of the training-data operators: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tasteflow.llm import (
    chat,
    collocations,
    decontaminate,
    jaccard_join,
    language_id,
    packing,
    quality_model,
    quality_rules,
    sharding,
    spelling_variants,
    suffix_dedup,
    token_counts,
    url_filter,
)
from tasteflow.llm.common import table

#: Rules of the URL query.
URL_RULES = [url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
             url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"),
             url_filter.Rule("block", "net", "/fr/")]

#: 2 regions of 2 racks of 4 shards.
SHARD_TREE = sharding.ShardTree.uniform(2, 2, 4)


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.report(table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "n_bad_lines", "n_lost_words", "kept")


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.report(table(spark, sf_dir, "documents"), k=3, pct=90)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"))
    numbered = sharding.slots(sharding.assign(rows, "doc_id", SHARD_TREE))
    return sharding.assign(numbered.withColumn("law", F.lit("key")), "doc_id", SHARD_TREE.grow(), "grown_shard")


def op8_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"),
                          public_tokenizers.PATTERN)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.render(table(spark, sf_dir, "conversations"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants.variants(table(spark, sf_dir, "documents"), slip=31)


def op12_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_suffix_dedup, op2_quality_rules, op3_decontaminate, op4_url_filter, op5_token_counts, op6_jaccard_join,
    op7_sharding, op8_packing, op9_chat_format, op10_quality_classifier, op11_spelling_variants, op12_language_id,
    op13_collocations)}
