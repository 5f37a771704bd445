"""Bounded samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(folds: int, fold: int) -> Column:
    """Whether a document is kept from learning; false for a null doc_id."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % folds == fold, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, label: str, out: Column, rows: int) -> DataFrame:
    """(doc_id, text, y) of at most ``rows`` labelled documents outside ``out``, chosen by
    hash of their id.

    Null ids, labels and labels other than 0 and 1 are left out; of several labels of one
    id the larger holds; a repeated id brings one of its texts.
    """
    known = labels.select("doc_id", F.col(label).cast("int").alias("y")).filter(F.col("y").isin(0, 1) & ~out)
    chosen = known.filter(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("y").alias("y"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # no more than ``rows`` ids
    return texts.groupBy("doc_id", "y").agg(F.min("text").alias("text"))
