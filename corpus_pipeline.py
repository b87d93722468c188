"""A training corpus from ``documents``: quality rules, near-dedup, decontamination, mix, token ids.

Each stage reads what the one before wrote and works on all of it. The last returns one row per document
of the mix as it lies in the token file. A document that the mix takes twice is there twice.

A stage runs many queries. What each of them exchanges is deleted as it ends: left to the driver's garbage
collection, the shuffle files of all queries of a stage, and of the stages before, lie on disk at once."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from buyerlens.llm import budget_mix, hamming_dedup, positional_index, quality_divergence, simple8b
from buyerlens.session import configure, releasing_shuffles, scratch_path


def _releasing(stage: Callable) -> Callable:
    """``stage``, whose own queries leave no shuffle files; the rows it returns are the caller's query."""
    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        with releasing_shuffles(spark):
            return stage(spark, docs, sf_dir)
    return run_stage


@_releasing
def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_divergence.keep_good(docs)


@_releasing
def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return hamming_dedup.keep_representatives(docs)


@_releasing
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return positional_index.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@_releasing
def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return budget_mix.mix(docs)


@_releasing
def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simple8b.encoded(docs)


STAGES = [
    ("quality rules", quality),
    ("near-dedup", near_dedup),
    ("decontamination", decontamination),
    ("source mix", mixing),
    ("token ids", token_ids),
]

#: No SQL: the stages link transitively, fill knapsacks and use a tokenizer. ``tests/llm`` compares
#: only the names of the stages; no test runs them chained.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to ``documents``; what a stage returns is written to the shared folder."""
    configure(spark)
    docs, folder = spark.read.parquet(f"{sf_dir}/documents.parquet"), scratch_path(spark)
    for i, (_, stage) in enumerate(STAGES):
        with releasing_shuffles(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}")
        docs = spark.read.parquet(f"{folder}/{i}")
    return docs
