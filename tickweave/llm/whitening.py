"""Whitened embeddings by Chebyshev-filtered subspace iteration.

The eigenvectors of the covariance are found without the covariance: a block of vectors
Q is sent over the table, each task adds up its rows' share of ZᵀZQ (Z: the centred rows),
and the sums come back, as large as Q. A Chebyshev polynomial of such products damps what
lies in the unwanted part of the spectrum, QR makes the block orthonormal again, and
Rayleigh-Ritz turns it to the eigenvectors it holds (Zhou and Saad 2007). This is repeated
until the residuals of all wanted pairs certify them.

Entries are whole numbers, ``floor(1024 * c) + 100000``, so that counts, sums and the
distance of a row from the mean are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import stage

COMPONENTS = 8
GUARDS = 24  # vectors of the block beside the wanted ones, which make the filter sharp
DEGREE = 10  # of the polynomial, so as many passes over the table a round
CERTIFIED = 1e-13  # residual of a pair, as a share of the largest eigenvalue
USABLE = 1e-9  # the same where rounding lets it get no better
ROUNDS = 60
FLAT = 1e-12  # a component with a smaller share of the largest eigenvalue has no variance
SCALE, SHIFT = 1024, 100_000
LARGEST = 2.0**40  # of an entry; ``x`` of a larger one is no exact long
SEED = 11


@dataclass
class Fit:
    """What a table says: its size, sums, and the leading eigenpairs."""

    n: int
    sums: np.ndarray  # whole numbers, one per dimension
    vectors: np.ndarray  # dimensions x components
    values: np.ndarray  # falling
    trace: float = 0.0
    rounds: int = 0
    residual: float = 0.0
    identity_error: float = 0.0

    def off(self, x: np.ndarray) -> np.ndarray:
        """``n * x`` less the sums, exactly."""
        if x.size and self.n * int(np.abs(x).max()) >= 1 << 62:
            x = x.astype(object)
        return self.n * x - self.sums

    def z(self, x: np.ndarray) -> np.ndarray:
        """Rows less the mean."""
        return self.off(x).astype(np.float64) / self.n

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.z(x) @ self.vectors / np.sqrt(self.values)


def _usable(vector: str) -> Column:
    held = F.forall(vector, lambda c: c.isNotNull() & (F.abs(c.cast("double")) <= LARGEST))
    return F.coalesce(held & (F.size(vector) > 0), F.lit(False))


def whole_numbers(vectors: DataFrame, vector: str = "embedding") -> DataFrame:
    """The usable rows of ``vectors``, written down, as ``row`` (a struct of all columns but
    the vector) and ``x``, the entries as whole numbers.

    Left out are rows whose vector is null, empty, or holds a null, NaN, infinite or huge
    entry (beyond 2^40), and those that have not the most frequent length of all others (of
    equally frequent ones the longest). Repeated rows and null ids stay.
    """
    kept = [F.col(f"`{c}`") for c in vectors.columns if c != vector]
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE) + SHIFT)
    made = stage(vectors.filter(_usable(vector)).select(F.struct(*kept).alias("row"), x.alias("x")), "whole-numbers")
    lengths = made.groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    common = lengths.orderBy(F.desc("n"), F.desc("d")).first()
    return made.filter(F.size("x") == (common.d if common else 0))


def _matrix(x: pa.Array) -> np.ndarray:
    """Equally long lists as one matrix."""
    return x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), -1)


def _summed(table: DataFrame, law, part: Callable) -> np.ndarray:
    """The sum of ``part(law, x)``, a matrix, over the batches of a table.

    Each task sends its matrix once, entry by entry, and entries are added up before the
    driver sees them, so what comes back is one matrix however large the table.
    """
    shared = table.sparkSession.sparkContext.broadcast(law)  # vectors of as many numbers as dimensions
    shape = part(law, np.zeros((1, len(law[0].sums)), np.int64)).shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(shape)
        for batch in batches:
            if batch.num_rows:
                total += part(shared.value, _matrix(batch.column("x")))
        yield pa.record_batch({"at": np.arange(total.size), "v": total.ravel()})

    parts = table.select("x").mapInArrow(work, "at long, v double").groupBy("at").agg(F.sum("v").alias("v"))
    found = parts.toArrow()
    shared.unpersist()
    total = np.zeros(shape)
    total.ravel()[found["at"].to_numpy()] = found["v"].to_numpy()
    return total


def _sums(table: DataFrame) -> tuple[int, np.ndarray]:
    """Rows, and the sum of each dimension, as whole numbers."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, 0
        for batch in batches:
            if batch.num_rows:
                x = _matrix(batch.column("x"))
                n, sums = n + len(x), sums + x.sum(0)
        if n:
            yield pa.record_batch({"i": np.arange(len(sums), dtype=np.int32), "n": np.full(len(sums), n), "s": sums})

    parts = table.select("x").mapInArrow(work, "i int, n long, s long").groupBy("i")
    rows = sorted(parts.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect())  # one per dimension
    return (rows[0].n if rows else 0), np.array([r.s for r in rows], np.int64)


def _image(law, x: np.ndarray) -> np.ndarray:
    """A batch's share of ZᵀZQ, and of the variances in the last column."""
    fit, q = law
    z = fit.z(x)
    return np.column_stack([z.T @ (z @ q), np.einsum("ij,ij->j", z, z)])


def _inner(law, x: np.ndarray) -> np.ndarray:
    w = law[0].whitened(x)
    return w.T @ w


def _filtered(times: Callable, q: np.ndarray, values: np.ndarray) -> np.ndarray:
    """A scaled Chebyshev polynomial of the covariance applied to ``q``: small on the
    spectrum from zero to the last of ``values``, growing fast above it."""
    half = values[-1] / 2  # the middle of the damped part, and half its width
    first = half / (values[0] - half)
    scale = first
    before, now = q, (times(q) - half * q) * (scale / half)
    for _ in range(DEGREE - 1):
        after = 1 / (2 / first - scale)
        before, now = now, (times(now) - half * now) * (2 * after / half) - scale * after * before
        scale = after
    return now


def learn(table: DataFrame, components: int = COMPONENTS, guards: int = GUARDS) -> Fit | None:
    """The leading eigenpairs of the covariance of ``x`` over a table of ``whole_numbers``;
    None without rows or without variance. Components without variance are left out.

    A pair is certified when its residual is within ``CERTIFIED`` of the largest
    eigenvalue, about what rounding leaves of any method; where the sums round more,
    rounds end when they bring nothing more and all residuals are within ``USABLE``.
    """
    n, sums = _sums(table)
    d = len(sums)
    if not n:
        return None
    fit = Fit(n, sums, np.zeros((d, 0)), np.zeros(0))
    q = np.linalg.qr(np.random.default_rng(SEED).standard_normal((d, min(d, components + guards))))[0]
    wanted, best = min(d, components), np.inf

    def times(v: np.ndarray) -> np.ndarray:
        found = _summed(table, (fit, v), _image) / n
        fit.trace = float(found[:, -1].sum())
        return found[:, :-1]

    for fit.rounds in range(1, ROUNDS + 1):
        image = times(q)
        if fit.trace <= 0:
            return None
        inner = q.T @ image
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, image = q @ turn, image @ turn
        fit.residual = float(np.linalg.norm(image - q * values, axis=0)[:wanted].max() / values[0])
        if fit.residual <= CERTIFIED or best / 2 < fit.residual <= USABLE:
            break
        best = min(best, fit.residual)
        damped = np.maximum(values, FLAT * values[0])
        if damped[-1] < damped[0] * 0.999999:
            q = _filtered(times, q, damped)
        q = np.linalg.qr(q)[0]
    else:
        raise RuntimeError(f"eigenvectors are not certified: residual {fit.residual:.1e}")
    rank = int((values[:wanted] > FLAT * values[0]).sum())
    fit.vectors, fit.values = q[:, :rank], values[:rank]
    fit.identity_error = float(np.abs(_summed(table, (fit,), _inner) / n - np.eye(rank)).max())
    return fit


def _applied(fit):
    kind = "struct<deviation:bigint,whitened:array<double>>"

    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        law = fit.value
        for lists in batches:
            x = _matrix(lists) if len(lists) else np.zeros((0, len(law.sums)), np.int64)
            off = law.off(x)
            if off.size and int(np.abs(off).max()) ** 2 * off.shape[1] >= 1 << 63:
                off = off.astype(object)
            squares = [s if s < 1 << 63 else None for s in (off * off).sum(1).tolist()]
            whitened = pa.array(list(law.whitened(x)), pa.list_(pa.float64()))
            yield pa.StructArray.from_arrays([pa.array(squares, pa.int64()), whitened], ["deviation", "whitened"])

    return F.arrow_udf(work, kind)


def whiten(table: DataFrame, fit: Fit) -> DataFrame:
    """``row``, ``deviation`` (the sum over the dimensions of (n x - S)^2, exact; null where
    no long holds it) and ``whitened``, one number per component, of each row of a table of
    ``whole_numbers``."""
    shared = table.sparkSession.sparkContext.broadcast(fit)  # components x dimensions
    found = table.select("row", _applied(shared)("x").alias("found"))
    return found.select("row", "found.deviation", "found.whitened")


def whitened_embeddings(vectors: DataFrame) -> DataFrame:
    """One row per usable vector and component, by ``whole_numbers`` and ``learn``. A table
    without usable rows, or all rows alike, gives none."""
    table = whole_numbers(vectors.select("vec_id", "embedding"))
    fit = learn(table)
    if fit is None:
        fit = Fit(0, np.zeros(0, np.int64), np.zeros((0, 0)), np.zeros(0), 1.0)
        table = table.limit(0)
    explained = F.array(*(F.lit(float(v / fit.trace)) for v in fit.values)).cast("array<double>")
    each = whiten(table, fit).select("row.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened"))
    return each.select(
        "vec_id",
        (F.col("at") + 1).alias("component"),
        F.lit(fit.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        explained[F.col("at")].alias("explained"),
        F.lit(fit.identity_error).alias("identity_error"),
    )
