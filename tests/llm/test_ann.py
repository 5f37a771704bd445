"""Neighbours against brute force, odd vectors, hot vectors."""

import random

import numpy as np
import pytest

from tickweave.llm import ann
from tickweave.llm.common import table


def brute(rows):
    """Every query's true neighbours, by exact scores and then ids."""
    ids, vectors = np.array([i for i, _ in rows]), np.array([v for _, v in rows], np.float64)
    out = {}
    for i, v in rows:
        if i % 20 == 0:
            score = ann.exact_scores(np.repeat(np.array([v], np.float64), len(ids), 0), vectors)
            order = [j for j in np.lexsort([ids, -score]) if ids[j] != i][:20]
            out[i] = [(int(ids[j]), float(score[j])) for j in order]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert len(out[r.query_id]) == r.rank
    return out


def check(got, wanted):
    assert set(got) == {q for q, hits in wanted.items() if hits}
    scores = {q: dict(hits) for q, hits in wanted.items()}
    same = 0
    for q, hits in got.items():
        assert len(hits) == len(wanted[q])
        assert hits == sorted(hits, key=lambda h: (-h[1], h[0]))
        same += sum(scores[q].get(i) == s for i, s in hits)
    return same / max(1, sum(map(len, wanted.values())))


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.1"])
def test_recall_on_whole_table(spark, sf):
    embeddings = table(spark, f"/root/testdata/{sf}", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in embeddings.collect()]
    assert check(found(ann.nearest_neighbours(embeddings)), brute(rows)) >= 0.9


def test_odd_vectors(spark, monkeypatch):
    monkeypatch.setattr(ann, "BLOCK", 50)
    monkeypatch.setattr(ann, "PART_QUERIES", 3)
    rng = random.Random(1)
    good = [(i, [rng.gauss(0, 1) for _ in range(5)]) for i in range(300)]
    good += [(i, [0.5, 0.25, 0.0, 0.0, 1.0]) for i in range(300, 500)]  # one vector many times
    bad = [(500, None), (520, []), (540, [0.0] * 5), (560, [1.0, None, 1.0, 1.0, 1.0]), (None, [1.0] * 5), (600, [1.0] * 4)]
    bad += [(580, [1.0, float("nan"), 0.0, 0.0, 0.0]), (581, [float("inf")] + [0.0] * 4)]
    df = spark.createDataFrame([(*r, 0) for r in good + bad], "vec_id long, embedding array<double>, cell int")
    assert check(found(ann.nearest_neighbours(df)), brute(good)) >= 0.9
    assert ann.nearest_neighbours(df.limit(0)).collect() == []
    few = spark.createDataFrame([(0, [1.0]), (1, [2.0]), (2, [-1.0])], "vec_id long, embedding array<double>")
    assert found(ann.nearest_neighbours(few)) == {0: [(1, 2.0), (2, -1.0)]}
