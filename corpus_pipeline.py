"""Documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and works on all documents its predecessor kept; all but the last
return the columns of documents. Rejected documents and near-duplicates go, secrets are masked in the text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sampleward.llm import packing, quality, secret_scan, simhash
from sampleward.llm.queries import WORD_BPE, read
from sampleward.sources.shared import stage


def quality_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are good and clean with a probability of 0.4 or more, of balanced grades."""
    return quality.select(docs, quality.train(docs, read(spark, sf_dir, "labels")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near-duplicates by SimHash, in the sense of op9_simhash."""
    return simhash.distinct_documents(docs)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked."""
    return secret_scan.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of power-of-two length with their token ids."""
    return packing.pack(docs, WORD_BPE)


STAGES = [
    ("quality_filter", quality_filter),
    ("near_dedup", near_dedup),
    ("mask_secrets", mask_secrets),
    ("pack_sequences", pack_sequences),
]
# The classifier and fingerprints are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each but the last written as Parquet and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
