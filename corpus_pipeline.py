"""Training-data pipeline over ``documents``: quality, near-dedup, substring dedup, mixing, packing.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; all but the last return the columns of ``documents``. What
each stage does with nulls, empty texts, ties, repeated rows, empty tables and
extra columns is stated in its operator's module.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickweave.llm import host_quality, mixing, near_dedup, packing, substring_dedup
from clickweave.session import staged


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and whose host is not rejected."""
    return host_quality.clean_documents(docs)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of smallest id, of each group of near copies."""
    return near_dedup.without_near_duplicates(docs)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without windows of 50 words that an earlier document has."""
    return substring_dedup.without_repeats(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources by temperature: each document once at least, and no source more than twice."""
    return mixing.mix_documents(docs, repetition_limit=2.0)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of 2048."""
    return packing.pack(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("mixing", mix_sources),
    ("packing", best_fit_packing),
]

#: SQL has neither the tokenizer nor the packing; tests/llm holds run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written before the next reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
