"""One query per operator over its whole table, by name, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tickweave.llm import ann, decontam, dialogue, langid, packing, pii, quality, secrets, sharding, simhash, sql, toxicity, warc, whitening
from tickweave.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archived(table(spark, sf_dir, "pages"))


def op6_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest_neighbours(table(spark, sf_dir, "embeddings"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_spans(table(spark, sf_dir, "documents"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened_embeddings(table(spark, sf_dir, "embeddings"))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repaired_conversations(table(spark, sf_dir, "conversations"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.languages(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Query]:
    return {q.__name__: q for q in (op1_secret_scan, op2_quality, op3_simhash_dedup, op4_toxicity, op5_warc, op6_nearest_neighbours, op7_pii, op8_decontamination, op9_packing, op10_sharding, op11_whitening, op12_conversation_repair, op13_language_id)}


def oracle_sql() -> dict[str, str]:
    return {"op1_secret_scan": sql.SECRETS, "op5_warc": sql.WARC, "op7_pii": sql.PII, "op8_decontamination": sql.DECONTAMINATION}
