"""Held-out accuracy, segments against all segments, odd rows."""

import random
import time
import zlib

import numpy as np
from test_quality import auc

from tickweave.llm import toxicity
from tickweave.llm.common import table


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.1"
    labels, docs = table(spark, sf_dir, "labels"), table(spark, sf_dir, "documents")
    rows = toxicity.toxicity(docs, labels).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    known = {r.doc_id: (r.toxic, r.quality) for r in labels.collect()}
    lang = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in rows if r.held_out and r.doc_id in known]
    y = np.array([known[r.doc_id][0] for r in held])
    p = np.array([r.predicted for r in held])
    found = auc(np.array([r.score for r in held]), y)
    print("recall", p[y == 1].mean(), "precision", y[p == 1].mean(), "auc", found, y.sum(), len(y))
    missed = [(r.doc_id, lang[r.doc_id], round(r.score, 3)) for r, t in zip(held, y) if t and not r.predicted]
    wrong = [(r.doc_id, lang[r.doc_id], round(r.score, 3)) for r, t in zip(held, y) if r.predicted and not t]
    print("missed", missed, "wrong", wrong)
    assert p[y == 1].mean() >= 0.85 and y[p == 1].mean() >= 0.95 and found >= 0.93


def test_segments_are_the_maximal_ones():
    def slow(scores, at=0):
        """The best segment, then those on its left and right (the definition)."""
        best = None
        for i in range(len(scores)):
            for j in range(i, len(scores)):
                s = sum(scores[i : j + 1])
                if s > 0 and (best is None or s > best[2]):
                    best = (i, j, s)
        if best is None:
            return []
        i, j, s = best
        return slow(scores[:i], at) + [(at + i, at + j, s)] + slow(scores[j + 1 :], at + j + 1)

    rng = random.Random(1)
    for _ in range(300):
        scores = [rng.choice([-0.53, -0.17, 0.31, 1.7, 2.9]) + rng.random() * 1e-3 for _ in range(rng.randint(0, 14))]
        got = toxicity.segments(np.array(scores))
        assert [(a, b) for a, b, _ in got] == [(a, b) for a, b, _ in slow(scores)]
        assert np.allclose([s for *_, s in got], [s for *_, s in slow(scores)])


def test_odd_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, 1.0), (1, "", 2.0), (None, "idiot", 3.0), (2, "word " * 200_000, 4.0), (3, "Idiot é\x00!", 5.0)],
        "doc_id long, text string, score double",
    )
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r.score for r in toxicity.toxicity(docs, none).collect()} == {0.0}
    odd = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1), (3, 7)], "doc_id long, toxic int")
    assert len(toxicity.toxicity(docs, odd).collect()) == 5
    assert toxicity.toxicity(docs.limit(0), odd).collect() == []


def test_passages(spark):
    model = toxicity.Model({b"idiot": 6.0, b"moro-": 4.0}, 1.5, 0.1, (-5.0, 1.0))
    text = "fine " * 50 + "you idiot and Moronic idiot " + "fine " * 50
    docs = spark.createDataFrame([(1, text), (2, "fine " * 100)], "doc_id long, text string")
    rows = {r.row.doc_id: r for r in toxicity.judge(docs, model).collect()}
    assert [p.passage for p in rows[1].passages] == ["idiot and moronic idiot"] and rows[2].passages == []
    assert rows[1].score > 0.99 and rows[2].score < 0.01


def test_segments_of_many_hits_take_linear_time():
    """Separated hits, each starting lower than the one before, and hits that all join."""

    def seconds(pattern, n):
        began = time.perf_counter()
        found = toxicity.segments(np.tile(pattern, n))
        return time.perf_counter() - began, len(found)

    for pattern, segments in (([1.0] + [-0.1] * 20, 1), ([1.0, -0.5], 0), ([0.5, -0.1, 0.7, -3.0], 1)):
        took, found = seconds(pattern, 100_000)
        assert found == (100_000 if segments else 1) and took < 5
        assert took < 40 * max(seconds(pattern, 10_000)[0], 0.01)
