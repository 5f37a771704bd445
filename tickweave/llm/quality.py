"""Quality of documents from their statistics, by boosted trees.

The trees are learned on the driver from the statistics of a bounded sample of labelled
documents; all documents are scored in batches with the flat form of the trees.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm import boosting
from tickweave.llm.common import whole
from tickweave.llm.labels import held_out, labelled

FIT_ROWS = 20_000  # labelled documents that the trees are learned from
FOLDS, FOLD = 4, 2
GOOD = 0.7

_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "blank": (32,),
    "line": (10, 13),
    "stop": tuple(b".,;:'\"?-()"),
    "shout": tuple(b"!"),
    "bar": tuple(b"|"),
    "sign": tuple(b"#$%&*@^~=+<>{}[]\\/_`"),
    "control": (*range(10), 11, 12, *range(14, 32), 127),
    "high": range(128, 256),
}
_CLASS_OF = np.zeros(256, np.int64)
for _i, _bytes in enumerate(_CLASSES.values()):
    _CLASS_OF[list(_bytes)] = _i
_SENTENCE = re.compile(rb"[.!?](?:\s|$)")


def statistics(text: bytes) -> list[float]:
    """Numbers that describe a text; an empty text has zeros alone."""
    size = len(text)
    shares = np.bincount(_CLASS_OF[np.frombuffer(text, np.uint8)], minlength=len(_CLASSES)) / max(size, 1)
    words = text.lower().split()
    n = len(words)
    counts = Counter(words)
    top = counts.most_common(3)
    lines = [line for line in text.split(b"\n") if line.strip()]
    lengths = np.array([len(w) for w in words] or [0])
    line_lengths = np.array([len(line) for line in lines] or [0])
    return [
        *shares.tolist(),
        np.log1p(size),
        np.log1p(n),
        float(lengths.mean()),
        float(lengths.std()),
        float(lengths.max()),
        len(counts) / max(n, 1),
        top[0][1] / n if top else 0.0,
        sum(c for _, c in top) / max(n, 1),
        len(set(lines)) / max(len(lines), 1),
        np.log1p(len(lines)),
        np.log1p(float(line_lengths.mean())),
        float(line_lengths.std()) / max(float(line_lengths.mean()), 1.0),
        len(_SENTENCE.findall(text)) / max(n, 1),
        sum(not w[-1:].isalnum() and w[-1] < 128 for w in words) / max(n, 1),
        sum(not w[:1].isalnum() and w[0] < 128 for w in words) / max(n, 1),
        len(zlib.compress(text, 1)) / max(size, 1),
    ]


def _rows(texts: pa.Array) -> np.ndarray:
    found = [statistics(t.as_py()) for t in texts.cast(pa.binary())]
    return np.array(found, np.float64).reshape(len(found), -1)


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = list(_rows(batch.column("text")))
        yield pa.record_batch({"y": batch.column("y").cast(pa.int32()), "x": pa.array(rows, pa.list_(pa.float64()))})


def learn(docs: DataFrame, labels: DataFrame, label: str = "quality", rows: int = FIT_ROWS) -> boosting.Trees:
    """Trees from at most ``rows`` labelled documents that are not held out."""
    chosen = labelled(docs, labels, label, held_out(FOLDS, FOLD), rows)
    texts = chosen.select("y", whole().alias("text"))
    measured = texts.mapInArrow(_measured, "y int, x array<double>").collect()  # as many as ``rows``
    measured.sort(key=lambda r: (r.y, r.x))  # the order of rows must not matter
    x = np.array([r.x for r in measured], np.float64)
    return boosting.fit(x, np.array([r.y for r in measured], np.float64))


def _scored(model):
    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            yield pa.array(model.value.scores(_rows(texts)) if len(texts) else [], pa.float64())

    return F.arrow_udf(work, "double")


def score(docs: DataFrame, model: boosting.Trees) -> DataFrame:
    """``docs`` as ``row`` (a struct of all its columns) with ``score``, 0 to 1. Null texts
    score like empty ones, and repeated rows alike."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.select(row.alias("row"), _scored(shared)(whole()).alias("score"))


def quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score and predicted."""
    scored = score(docs.select("doc_id", "text"), learn(docs, labels)).select("row.doc_id", "score")
    predicted = (F.col("score") >= GOOD).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(FOLDS, FOLD).alias("held_out"), "score", predicted)
