"""The registered queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from venueflow.llm import (
    alignment, licenses, linededup, mixing, neighbours, packing, periods, pii, quality, sentencepieces, simhash, tokenfiles, toxicity,
)
from venueflow.llm.registry import QUERIES, SQL, query, table  # noqa: F401
from venueflow.session import materialize, new_shared_path


@query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


@query("op2_token_packing")
def op2_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where every segment of every document stands in the packed matrices, which are written to the shared folder."""
    folder = new_shared_path(spark, "packed")
    segments = materialize(packing.pack(table(spark, sf_dir, "documents"), folder), "packed-segments")
    packing.write_manifest(segments, folder)
    return segments


@query("op3_simhash_near_dedup")
def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash(table(spark, sf_dir, "documents"))


@query("op4_nearest_neighbours")
def op4_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


@query("op5_license_scan", licenses.sql())
def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


@query("op6_toxicity")
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the digest of the text they decode to."""
    encoded = sentencepieces.encode(table(spark, sf_dir, "documents").select("doc_id", "text"))
    decoded = sentencepieces.decode(encoded)
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("same_text"),
    )


@query("op8_token_counts")
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.token_counts(table(spark, sf_dir, "documents"))


@query("op9_quality_rules", quality.sql())
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents")).select("doc_id", *quality.COUNTS, "base_failed", "kept")


@query("op10_mixing", mixing.sql())
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.with_positions(mixing.mix(table(spark, sf_dir, "documents")))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "first_position").orderBy("first_position", "doc_id")


@query("op11_line_dedup", linededup.sql())
def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = linededup.drop_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op12_token_alignment")
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(table(spark, sf_dir, "documents"))


@query("op13_periodic_runs")
def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of all documents, a tenth of which are made to repeat a phrase of their own first."""
    return periods.report(periods.periodic_runs(periods.with_loops(table(spark, sf_dir, "documents"))))
