"""Whitening against a dense eigensolver, and what its docstrings say of odd input."""

import random

import numpy as np
import pytest

from tickweave.llm import whitening
from tickweave.llm.catalog import queries
from tickweave.llm.common import table

VECTORS = "vec_id long, embedding array<float>, label int"


def dense(vectors):
    """n, deviations, eigenvalues and eigenvectors by plain numpy."""
    x = np.array([[int(np.floor(float(np.float32(c)) * 1024)) + 100_000 for c in v] for v in vectors])
    off = len(x) * x.astype(object) - x.sum(0).astype(object)
    z = off.astype(float) / len(x)
    values, vectors = np.linalg.eigh(z.T @ z / len(x))
    return (off * off).sum(1), z, values[::-1], vectors[:, ::-1]


def check(found, ids, vectors):
    """``found`` rows of the query against the dense solution of these vectors."""
    deviation, z, values, turn = dense(vectors)
    k = min(8, z.shape[1])
    assert len(found) == len(ids) * k
    rows = sorted(found, key=lambda r: (r.vec_id, r.deviation, r.component, r.whitened))
    assert {(r.vec_id, r.deviation) for r in rows} == set(zip(ids, deviation))
    assert {r.n for r in rows} == {len(ids)}
    assert len({r.identity_error for r in rows}) == 1 and rows[0].identity_error < 1e-9
    by = {(r.vec_id, r.component): r for r in rows}
    for c in range(k):
        want = z @ turn[:, c] / np.sqrt(values[c])
        got = np.array([by[i, c + 1].whitened for i in ids])
        assert min(np.abs(got - want).max(), np.abs(got + want).max()) < 1e-7
        assert by[ids[0], c + 1].explained == pytest.approx(values[c] / values.sum(), rel=1e-9)


def test_query_against_dense_solver(spark, sf_dir):
    given = table(spark, sf_dir, "embeddings").collect()
    found = queries()["op11_whitening"](spark, sf_dir).collect()
    check(found, [r.vec_id for r in given], [r.embedding for r in given])


def test_unusable_rows_take_no_part(spark):
    random.seed(1)
    good = [(i, [random.gauss(0, 1 + j) for j in range(12)]) for i in range(300)]
    bad = [None, [], [1.0] * 11, [None] + [1.0] * 11, [float("nan")] + [1.0] * 11, [float("inf")] * 12, [3e30] * 12]
    rows = [(i, v, 0) for i, v in good] + [(1000 + i, v, 0) for i, v in enumerate(bad)]
    df = spark.createDataFrame(rows, VECTORS).repartition(7)
    check(whitening.whitened_embeddings(df).collect(), *zip(*good))


@pytest.mark.parametrize("d", [1, 3, 9])
def test_fewer_dimensions_than_the_block(spark, d):
    random.seed(d)
    rows = [(i, [random.gauss(0, 1 + j) for j in range(d)], 0) for i in range(50)]
    found = whitening.whitened_embeddings(spark.createDataFrame(rows, VECTORS)).collect()
    check(found, *zip(*((i, v) for i, v, _ in rows)))


def test_nothing_to_whiten(spark):
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    for rows in ([], [(1, None, 0)], [(1, [0.5, 1.0], 0)], [(i, [0.5, 1.0], 0) for i in range(5)]):
        found = whitening.whitened_embeddings(spark.createDataFrame(rows, VECTORS))
        assert found.columns == names and found.count() == 0


def test_components_without_variance_are_left_out(spark):
    rows = [(i % 5, [float(i), 2.0 * i, 7.0], 0) for i in range(20)]  # repeated ids stay
    found = whitening.whitened_embeddings(spark.createDataFrame(rows, VECTORS)).collect()
    assert {r.component for r in found} == {1} and len(found) == 20
    assert sum(r.whitened**2 for r in found) / 20 == pytest.approx(1)


def test_sums_of_squares_beyond_a_long(spark):
    rows = [(i, [1e12 * (i % 2), 0.0], 0) for i in range(4)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert {r.deviation for r in whitening.whitened_embeddings(df).collect()} == {None}


def test_many_close_eigenvalues_are_certified(spark):
    made = np.random.default_rng(5).standard_normal((3000, 80))
    df = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(made)], VECTORS)
    fit = whitening.learn(whitening.whole_numbers(df))
    *_, values, turn = dense(made)
    assert fit.residual <= whitening.CERTIFIED
    assert np.abs(fit.values / values[:8] - 1).max() < 1e-12
    assert 1 - np.abs((fit.vectors * turn[:, :8]).sum(0)).min() < 1e-12


def test_clashing_columns(spark):
    df = spark.createDataFrame([(i, [float(i), -float(i * i)], "a", 2) for i in range(9)], "vec_id long, embedding array<float>, x string, row int")
    made = whitening.whole_numbers(df)
    out = whitening.whiten(made, whitening.learn(made))
    assert out.columns == ["row", "deviation", "whitened"] and out.select("row.x", "row.row").distinct().count() == 1
