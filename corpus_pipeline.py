"""A corpus pipeline over ``documents``: quality rules, toxicity, near duplicates, repeated passages, packing.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame, which ``run`` writes as Parquet to the shared folder and rereads as the next one's docs.
All stages but the last return the columns of docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripmart.llm import best_fit, jaccard_join, quality_rules, substring_dedup, toxicity
from tripmart.llm.common import ship, stored, table


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship(spark)
    return quality_rules.filter_documents(docs)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score under the toxicity threshold; the model learns from the labels of these docs."""
    return toxicity.filter_documents(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates."""
    ship(spark)
    return jaccard_join.filter_documents(docs)


def cut_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that an earlier document has too."""
    ship(spark)
    return substring_dedup.filter_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of every document with its place in a training sequence."""
    ship(spark)
    return best_fit.pack(docs)


STAGES = [
    ("quality_rules", keep_good),
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("substring_dedup", cut_passages),
    ("best_fit_packing", pack_sequences),
]

#: The stages are iterative or use a tokenizer; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
