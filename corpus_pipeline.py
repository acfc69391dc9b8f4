"""The corpus pipeline: language ID, exact dedup, near-dedup, personal data, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
next stage's docs. All but the last return the columns of documents; the last returns the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from farelane.llm import exact_dedup, language_id, near_dup, packing, pii
from farelane.llm.common import fresh_folder, table


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language isn't rejected; the classifier learns from the labelled ones among them."""
    return language_id.keep_known(docs, language_id.fit(docs))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents with equal normalised text the one with the smallest doc_id."""
    return exact_dedup.dedup(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near-duplicates the document with the smallest doc_id."""
    return near_dup.keep_one(docs)


def without_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data in their texts replaced by its kind."""
    return pii.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents, packed into sequences."""
    return packing.pack(packing.pieces(docs))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("minhash_near_dedup", without_near_copies),
    ("pii", without_personal_data),
    ("best_fit_packing", packed),
]

#: A trained classifier, signatures and a tokenizer are beyond SQL; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        at = f"{fresh_folder(spark, 'pipeline')}/{name}"
        out.write.parquet(at)
        docs = spark.read.parquet(at)
    return docs
