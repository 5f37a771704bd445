"""A corpus from raw documents to packed training sequences.

Each stage reads what the one before it wrote and keeps: toxic documents go, of near
duplicates one document stays, documents that hold benchmark passages go, personal data
is masked in the texts, and what is left is packed into sequences.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickweave.llm.common import stage, table
from tickweave.llm.decontam import drop_contaminated
from tickweave.llm.packing import pack
from tickweave.llm.pii import mask_pii
from tickweave.llm.simhash import drop_near_duplicates
from tickweave.llm.toxicity import drop_toxic

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that score as toxic; learned from ``labels``."""
    return drop_toxic(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest doc_id, of each component of SimHash fingerprints
    of three-word shingles that differ in 3 or fewer bits."""
    return drop_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the documents that hold ten consecutive words of ``benchmark``."""
    return drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data masked in their texts."""
    return mask_pii(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("pii", pii),
    ("packing", packing),
]

# Learned scores, classes of near duplicates and packing have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written down before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, work in STAGES:
        docs = stage(work(spark, docs, sf_dir), name)
    return docs
