"""Corpus pipeline over the documents table: stages whose results are written and read again.

Language identification drops documents without a recognized language, near-dedup (five-word shingles, similarity 0.8)
leaves one document of each group, decontamination drops documents that contain a benchmark item, mixing emits every
document as often as the mix takes it, and the last stage writes the token files and returns what they hold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfwise.llm.common import scratch, table
from shelfwise.llm.decontaminate import clean
from shelfwise.llm.language_id import identified
from shelfwise.llm.mixing import mix
from shelfwise.llm.near_dedup import deduplicated
from shelfwise.llm.token_blocks import token_files


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognized."""
    return identified(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every group of near copies."""
    return deduplicated(docs, shingle=5, threshold=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return clean(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    return mix(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every emitted document, from the token files."""
    return token_files(docs)


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]
#: The first stage is a trained classifier, which SQL cannot express; tests compare every stage with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        path = scratch(spark, f"stage{k}-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
