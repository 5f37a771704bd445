"""Held-out accuracy, odd rows, and the trees against a walk row by row."""

import zlib

import numpy as np

from tickweave.llm import boosting, quality
from tickweave.llm.common import table


def auc(scores, labels):
    order = np.argsort(scores)
    ranks = np.empty(len(scores))
    ranks[order] = np.arange(len(scores))
    for v in np.unique(scores):
        ranks[scores == v] = ranks[scores == v].mean()
    one = labels == 1
    return (ranks[one].sum() - one.sum() * (one.sum() - 1) / 2) / (one.sum() * (~one).sum())


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels = table(spark, sf_dir, "labels")
    rows = quality.quality(table(spark, sf_dir, "documents"), labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    known = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in known]
    y = np.array([known[r.doc_id] for r in held])
    hit = np.mean([r.predicted == known[r.doc_id] for r in held])
    found = auc(np.array([r.score for r in held]), y)
    print("accuracy", hit, "auc", found, "share of label 1", y.mean(), len(y))
    assert hit >= 0.95 and found >= 0.95


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1.0), (1, "", 2.0), (None, "x", 3.0), (2, "word " * 200_000, 4.0), (3, "é\x00  !", 5.0)],
        "doc_id long, text string, score double",
    )
    none = spark.createDataFrame([], "doc_id long, quality int")
    rows = quality.quality(docs, none).collect()
    assert len(rows) == 5 and {r.score for r in rows} == {0.5}
    assert [r.held_out for r in rows if r.doc_id is None] == [False]
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 7)], "doc_id long, quality int")
    assert len(quality.quality(docs, odd).collect()) == 5
    assert quality.quality(docs.limit(0), odd).collect() == []


def test_trees_against_rows():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 4))
    y = ((x[:, 0] > 0) ^ (x[:, 2] > 0.5)).astype(float)
    model = boosting.fit(x, y)
    scores = model.scores(x)
    assert ((scores > 0.5) == y).mean() > 0.97

    def walk(row):
        total = model.base
        for node in model.root:
            while model.left[node] != node:
                node = model.left[node] if row[model.feature[node]] <= model.threshold[node] else model.right[node]
            total += model.value[node]
        return 1 / (1 + np.exp(-total))

    assert np.allclose([walk(r) for r in x[:50]], scores[:50])
