"""A training corpus from raw documents, stage by stage.

Each stage takes what its predecessor kept and returns the columns of documents; the last
one returns token pieces with their places in sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from qualitygate.llm import packing, quality, secret_scan, simhash
from qualitygate.llm.common import documents, spool
from qualitygate.llm.exact_dedup import drop_copies


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects go."""
    return quality.drop_rejected(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays."""
    return drop_copies(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies stays: fingerprints of four-word shingles that differ in at most four bits, and what they connect."""
    return simhash.drop_near_copies(docs, words=4, bits=4)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay. ``n_chars`` follows the text where that changed."""
    return secret_scan.redact(docs, count="n_chars")


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048."""
    import public_tokenizers  # only here, so that the other stages do not need it

    return packing.pack(packing.token_pieces(docs, public_tokenizers.path("byte_bpe_50k.json")))


STAGES = [
    ("quality_classifier", quality_classifier),
    ("exact_dedup", exact_dedup),
    ("simhash_near_dedup", simhash_near_dedup),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]

#: Models are trained and fingerprints hashed with XXH64: SQL can't express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents; each is written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = spool(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
