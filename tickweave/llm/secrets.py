"""Secret scan over every historical version of texts, with a ledger of scanned blobs.

A blob is named by the SHA-256 of its text. The ledger holds, for each pair of blob
and rule version, the spans that the scan found. A scan reads only pairs that the
ledger lacks, each blob once however many paths hold it, and joins the findings back
to all paths.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.llm.common import scratch, stage, whole
from tickweave.llm.spans import SPAN, Rule, digest, propose

RULES = [
    Rule(
        "assign",
        r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        inner=2,
    ),
    Rule("access", r"AKIA[A-Z0-9]{16,}+"),
    Rule("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+"),
    Rule("pem", r"-----BEGIN\x20(?:[A-Z]+\x20)?PRIVATE\x20KEY-----", base=False),
    Rule("forge", r"gh[pousr]_[A-Za-z0-9]{36}", base=False),
]
VALUE = 6  # code points an assigned value has at least
LEDGER = f"blob string, rules string, spans {SPAN}"


def rule_version(rules: list[Rule]) -> str:
    """Changes with any rule, so that changed rules scan all blobs again."""
    return hashlib.sha256(repr((rules, VALUE)).encode()).hexdigest()[:16]


def _confirmed(span: Column) -> Column:
    return (span["kind"] != "assign") | (F.length(span["inner"]) >= VALUE)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """The ledger below ``path``; empty where nothing was written yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], LEDGER)


def update_ledger(versions: DataFrame, path: str, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """Scan the blobs of ``versions`` that the ledger at ``path`` lacks under these
    rules, append them, and return the ledger's rows of this rule version.

    A failed or repeated update may leave a blob twice; readers take one of them,
    and both hold the same spans.
    """
    spark, version = versions.sparkSession, rule_version(rules)
    known = read_ledger(spark, path).filter(F.col("rules") == version)
    blobs = versions.select(whole(text).alias("text")).withColumn("blob", F.sha2("text", 256))
    # Copies go first, mostly before the shuffle; the join then finds its rows in place.
    unseen = blobs.dropDuplicates(["blob"]).join(known, "blob", "left_anti")
    found = propose(unseen, "text", rules, "proposed")
    found.select(
        "blob", F.lit(version).alias("rules"), F.filter("proposed", _confirmed).alias("spans")
    ).write.mode("append").parquet(path)
    return read_ledger(spark, path).filter(F.col("rules") == version)


def scan_secrets(versions: DataFrame, path: str, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """One row per version: ``row`` (a struct of all its columns but the text), its
    ``blob``, and ``secrets``, the spans with start, end (code points, end exclusive),
    kind and value. Null texts are the empty blob. Repeated rows and null paths stay
    as they are; an empty table gives no rows.
    """
    ledger = update_ledger(versions, path, text, rules)
    # Written down, so that the join below has nothing but its two sides and Spark can
    # split the blob that a third of the paths may hold.
    found = stage(ledger.groupBy("blob").agg(F.first("spans").alias("secrets")), "blob-findings")
    kept = [F.col(f"`{c}`") for c in versions.columns if c != text]
    paths = versions.select(F.struct(*kept).alias("row"), F.sha2(whole(text), 256).alias("blob"))
    return paths.join(found, "blob", "left").select("row", "blob", "secrets")


def secret_spans(docs: DataFrame) -> DataFrame:
    """One row per document: counts and places of secrets, with a ledger of its own."""
    path = scratch(docs.sparkSession, "blob-ledger")
    found = scan_secrets(docs.select("doc_id", "text"), path).select("row.doc_id", "secrets")
    return digest(found, "doc_id", "secrets", RULES)
