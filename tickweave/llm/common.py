"""Small helpers shared by the operators of this folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.storage import scratch, stage

__all__ = ["carried", "scratch", "stage", "table", "whole"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole(text: str = "text") -> Column:
    """The whole text; a null text counts as empty."""
    return F.coalesce(F.col(text), F.lit(""))


def carried(docs: DataFrame, *computed: Column) -> DataFrame:
    """All columns of ``docs`` in one struct ``row`` beside computed ones, so that
    no column of the input can clash with a computed name."""
    return docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), *computed)
