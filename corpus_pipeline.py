"""Training-data pipeline: from the documents table to packed windows.

Every stage works on all rows that the one before it kept; its result is written as Parquet and read again.
All stages but the last return the columns of their input.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywork.llm import blocks, jaccard, packing, repetition, secret_scan
from tallywork.llm.store import batches_of, written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that repeat themselves, are too short or full of symbols go."""
    batches_of(spark, BATCH_ROWS)
    return repetition.keep_clean(docs)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the smallest id stays."""
    batches_of(spark, BATCH_ROWS)
    return blocks.drop_copies(docs)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the one with the smallest id stays."""
    batches_of(spark, BATCH_ROWS)
    return jaccard.keep_one(docs)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret values are masked; every document stays."""
    batches_of(spark, BATCH_ROWS)
    return secret_scan.mask_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Windows of tokens with lexical neighbours side by side."""
    batches_of(spark, BATCH_ROWS)
    return packing.digests(packing.pack(docs))


#: rows that go to a Python worker at a time; texts are long, and a batch is held by the worker and the JVM beside it
BATCH_ROWS = 1_000

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("secret_scans", secret_scans),
    ("packing", pack),
]

#: the stages cannot be written in SQL; tests compare run() with brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
