"""A corpus pipeline: quality rules, near-duplicates, private data, mixing, token ids.

Each stage is written as Parquet and read again as the next one's documents. All but the last return
the columns of ``documents``; the last adds piece ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from venueflow.llm import mixing, pii, quality, sentencepieces, simhash
from venueflow.session import materialize


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go."""
    return quality.filter_quality(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays."""
    return simhash.drop_near_duplicates(docs)


def mask_private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data are replaced by their kind."""
    return pii.mask_pii(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in training order, as often as the mix takes them."""
    return mixing.training_order(docs)


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Piece ids of every document beside its columns."""
    return sentencepieces.encode(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("mask_private_data", mask_private_data),
    ("mix_sources", mix_sources),
    ("encode_pieces", encode_pieces),
]

ORACLE_SQL = None  # fingerprints, span model and merge model have no SQL; tests/llm compares with plain Python


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
