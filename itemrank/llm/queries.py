"""The registered queries of the training-data operators: key -> (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (conversation_trie, decontaminate, hard_negatives, license_scan, lm_score, minhash_dedup, mixing, oracle,
               quality_qda, quality_rules, sharding, substring_dedup, token_counts, warc_revisits)
from .common import table


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.score_texts(table(spark, sf_dir, "documents"))


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licenses(table(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard_table(docs, sharding.SMALL_LIMIT)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = warc_revisits.resolve_revisits(warc_revisits.captures_of(table(spark, sf_dir, "pages")))
    return found.withColumn("headers", warc_revisits.header_text(F.col("headers")))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(hard_negatives.scaled_vectors(table(spark, sf_dir, "embeddings")))


def op13_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_license_scan": op3_license_scan,
    "op4_quality_rules": op4_quality_rules,
    "op5_minhash_near_dedup": op5_minhash_near_dedup,
    "op6_sharding": op6_sharding,
    "op7_token_counts": op7_token_counts,
    "op8_mixing": op8_mixing,
    "op9_decontamination": op9_decontamination,
    "op10_warc_revisits": op10_warc_revisits,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_quality_classifier": op13_quality_classifier,
}

ORACLE_SQL: dict[str, str] = dict(oracle.SQL)
