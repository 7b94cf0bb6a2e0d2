"""From raw documents to sharded training text, in five stages.

Each stage works on all its predecessor kept. `run` writes every stage's result to the shared folder and
reads it again, so a lost executor repeats at most one stage's tasks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from assaylake.llm import decontamination, language_id, mixing, near_duplicates, sharding
from assaylake.sources.scratch import written_table
from assaylake.sources.tables import table


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters or without a clear language."""
    return language_id.accepted(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of exact and near copies."""
    return near_duplicates.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a window of a benchmark item."""
    return decontamination.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix at the target weights: a row per document and pass, with the words taken in it."""
    return mixing.mixed_documents(docs, mixing.mixture(docs))


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and place of every document of the mix."""
    return sharding.shard_rows(docs)


STAGES = [
    ("language_id", language_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# Trained likelihoods, sampled paths and pseudorandom draws are beyond SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir))
    return docs


QUERIES = {"pipeline": (run, ORACLE_SQL)}
