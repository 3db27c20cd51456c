"""The corpus pipeline: five stages over `documents`, each fed with what the one before kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame: documents' columns, the last one token counts and digests. What
a stage does with nulls, empty tables, repeated rows and clashing columns is told by the operator that it calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from watchloom.llm import bpe, jaccard, mixing, quality, toxicity
from watchloom.llm.common import materialise


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier doesn't reject."""
    return quality.selected(docs, labels(spark, sf_dir))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the random field doesn't find toxic."""
    return toxicity.clean(docs, labels(spark, sf_dir))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more."""
    return jaccard.distinct_documents(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    return mixing.mixed(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of each document of the mix."""
    return bpe.digests(docs)


STAGES = [("quality", keep_quality), ("toxicity", drop_toxic), ("near copies", drop_near_copies), ("mixing", mix_sources), ("byte BPE", encode)]

#: SQL can't express the trained models.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
