"""Cleaning a corpus: five of the operators one after the other.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and all
but the last return the columns of ``documents``.  ``run`` writes each stage's result to
the shared scratch folder and reads it again, so that a lost executor costs no stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from clickloom.llm import exact_dedup, jaccard_join, packing, quality, secret_scan
from clickloom.llm.scratch import stored
from clickloom.sources.testdata import table

# Near copies share at least NEAR of 100 shingles of SHINGLE words (op4 has its own contract).
SHINGLE, NEAR = 5, 80


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the classifier rejects."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the preferred one of every group of equal texts."""
    return exact_dedup.keep_first(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the first document of every component of near copies."""
    return jaccard_join.keep_one(docs, size=SHINGLE, least=NEAR, of=100)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask the secrets; the documents stay."""
    return secret_scan.mask_secrets(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every document's pieces into sequences."""
    return packing.pack_documents(docs, keep_ids=False).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [("quality_classifier", good_quality), ("exact_dedup", without_copies),
          ("jaccard_join", without_near_copies), ("secret_scan", without_secrets),
          ("best_fit_packing", packed)]

# The classifier, the token ids and the packing are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
