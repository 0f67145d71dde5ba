"""Registered queries of the text operators: ``opN_<name>`` over whole tables, and their SQL where there is one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import (best_fit, collocations, fingerprints, hard_negatives, jaccard_join, license_scan, positional_index, quality_rules,
                          repair_output, substring_dedup, token_counts, toxicity, trie_bpe)
from tripmart.llm.common import table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit.pack(table(spark, sf_dir, "documents"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.find(table(spark, sf_dir, "documents"))


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"))


def op6_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_bpe.digests(table(spark, sf_dir, "documents"))


def op7_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "distance2")


def op9_repair_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_output.digests(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents")).select("doc_id", "license", "containment")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return positional_index.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hard_negatives.hard_negatives(table(spark, sf_dir, "embeddings"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_toxicity, op2_best_fit_packing, op3_substring_dedup, op4_fingerprints, op5_token_counts,
                                   op6_trie_bpe, op7_ngram_jaccard_join, op8_quality_rules, op9_repair_output, op10_license_scan,
                                   op11_decontamination, op12_hard_negatives, op13_collocations)}


def oracle_sql() -> dict[str, str]:
    return {"op10_license_scan": license_scan.sql(), "op11_decontamination": positional_index.sql(),
            "op12_hard_negatives": hard_negatives.sql(), "op13_collocations": collocations.sql()}
