"""The training-data pipeline over documents: quality rules, line dedup, near dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir), works on all rows it gets and keeps the columns of ``docs``; the last returns the pieces of
the packed sequences. Between stages the rows are written to the shared folder, so a lost executor costs one stage's tasks at most.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from scanledger.llm import decontaminate, line_dedup, near_dedup, packing, quality
from scanledger.llm.common import table, written


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops failing lines, and documents that fail or lose too much."""
    return quality.keep_quality(docs)


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops lines that three or more documents hold, but from the largest doc_id."""
    return line_dedup.dedup_lines(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    return near_dedup.dedup_near(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 1024 tokens with their places in sequences."""
    return packing.pack_documents(docs.select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination),
    ("best_fit_packing", best_fit_packing),
]

# near duplicates and packing go beyond SQL; tests/llm compares them with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
