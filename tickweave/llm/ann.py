"""Approximate nearest neighbours by an inverted multi-index.

Vectors are cut in two halves, and each half is quantised by centroids of its own; a
pair of centroids is a cell. For a query, cells are taken in the order of the summed
inner products of the two halves, by a heap over the sorted centroids, until they hold
a stated number of entries. These are ranked again by the exact measure.

The number is not fixed: it is set so that, for a bounded sample of queries searched in
all vectors, a stated share of the true neighbours lies in the cells taken.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickweave.llm.common import stage

NEAREST = 20
CENTROIDS = 32  # of each half
FIT_ROWS = 20_000  # vectors, by hash of their id, that fit the centroids
FIT_ROUNDS = 8
PROBE_ROWS = 128  # queries, by hash of their id, that set how many entries are ranked
COVERED = 0.95  # share of their true neighbours that the cells taken must hold
BLOCK = 4096  # entries that are ranked together
QUERIES = 512  # queries that are ranked together
PART_QUERIES = 20_000  # queries that one task holds
VECTOR = "id long, vector array<double>"


@dataclass
class Cells:
    left: np.ndarray
    right: np.ndarray

    @property
    def half(self) -> int:
        return self.left.shape[1]

    def of(self, vectors: np.ndarray) -> np.ndarray:
        a, b = _nearest(vectors[:, : self.half], self.left), _nearest(vectors[:, self.half :], self.right)
        return a * len(self.right) + b

    def taken(self, query: np.ndarray, sizes: np.ndarray, wanted: int) -> list[int]:
        """Cells in falling order of the summed inner products, until they hold
        ``wanted`` entries."""
        a, b = self.left @ query[: self.half], self.right @ query[self.half :]
        by_a, by_b = np.argsort(-a, kind="stable"), np.argsort(-b, kind="stable")
        heap, seen, cells, held = [(-(a[by_a[0]] + b[by_b[0]]), 0, 0)], {(0, 0)}, [], 0
        while heap and held < wanted:
            _, i, j = heapq.heappop(heap)
            cell = int(by_a[i] * len(by_b) + by_b[j])
            if sizes[cell]:
                cells.append(cell)
                held += int(sizes[cell])
            for x, y in ((i + 1, j), (i, j + 1)):
                if x < len(by_a) and y < len(by_b) and (x, y) not in seen:
                    seen.add((x, y))
                    heapq.heappush(heap, (-(a[by_a[x]] + b[by_b[y]]), x, y))
        return cells


def _nearest(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return np.argmax(vectors @ centroids.T - 0.5 * (centroids * centroids).sum(1), axis=1)


def _centroids(vectors: np.ndarray, count: int) -> np.ndarray:
    """Lloyd's rounds from evenly spread vectors."""
    if not vectors.shape[1]:
        return np.zeros((1, 0))
    distinct = np.unique(vectors, axis=0)
    centroids = distinct[np.linspace(0, len(distinct) - 1, min(count, len(distinct))).astype(int)].copy()
    for _ in range(FIT_ROUNDS):
        own = _nearest(vectors, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, own, vectors)
        size = np.bincount(own, minlength=len(centroids))
        centroids[size > 0] = sums[size > 0] / size[size > 0, None]
    return centroids


def usable(table: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector) of the rows that take part: with an id, and with a vector that is
    neither null, empty nor zero, has finite components alone, and is as long as most
    such vectors are (the shorter length if two are as common)."""
    rows = table.select(F.col(key).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("vector"))
    good = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("id").isNotNull() & F.col("vector").isNotNull())
    rows = rows.filter(good & F.exists("vector", lambda x: x != 0))
    lengths = rows.groupBy(F.size("vector").alias("length")).agg(F.count(F.lit(1)).alias("n"))
    usual = lengths.orderBy(F.desc("n"), "length").first()
    return rows.filter(F.size("vector") == (usual.length if usual else 0))


def _sample(rows: DataFrame, total: int, count: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` rows of ``total`` with the least hashes of their ids. Hashes far above
    the ``count``-th are left out first, so a task sends its share of the sample alone."""
    place = F.xxhash64(F.lit(seed), "id")
    least = (count + 6 * count**0.5) / max(total, 1)
    near = rows.filter(place / F.lit(2.0**64) + 0.5 <= least)
    taken = near.orderBy(place, "id").limit(count).collect()
    return np.array([r.id for r in taken], np.int64), np.array([r.vector for r in taken], np.float64)


def fit(rows: DataFrame, total: int) -> Cells:
    _, sample = _sample(rows, total, FIT_ROWS, 1)
    half = sample.shape[1] // 2
    return Cells(_centroids(sample[:, :half], CENTROIDS), _centroids(sample[:, half:], CENTROIDS))


def _celled(cells):
    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield batch.assign(cell=cells.value.of(np.stack(batch["vector"])))

    return work


def exact_scores(queries: np.ndarray, vectors: np.ndarray) -> np.ndarray:
    """Inner products of rows, summed component by component, so that equal vectors
    score alike wherever they stand."""
    total = np.zeros(len(queries))
    for d in range(queries.shape[1]):
        total += queries[:, d] * vectors[:, d]
    return total


def _best(query_ids, queries, ids, vectors, allowed, nearest):
    """The best ``nearest`` of a block of entries for every query, as (query, id, score)."""
    rough = np.where(allowed & (query_ids[:, None] != ids[None]), queries @ vectors.T, -np.inf)
    at = min(nearest, rough.shape[1]) - 1
    least = -np.partition(-rough, at, axis=1)[:, at]
    # The rough products differ from the exact ones in the last digits.
    slack = 1e-12 * np.linalg.norm(queries, axis=1) * np.linalg.norm(vectors, axis=1).max(initial=0)
    q, v = np.nonzero((rough >= (least - slack)[:, None]) & (rough > -np.inf))
    score = exact_scores(queries[q], vectors[v])
    order = np.lexsort([ids[v], -score, q])
    q, v, score = q[order], v[order], score[order]
    rank = np.arange(len(q)) - np.searchsorted(q, q)
    keep = rank < nearest
    return query_ids[q[keep]], ids[v[keep]], score[keep]


def _probed(probes, nearest):
    """For sampled queries the best entries of each batch, with their cells."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names, queries = probes.value
        for batch in batches:
            if len(batch):
                vectors, rows = np.stack(batch["vector"]), np.arange(len(batch))
                other = names[:, None] != batch["id"].to_numpy()[None]
                q, v, score = _best(np.arange(len(names)), queries, -1 - rows, vectors, other, nearest)
                entry = batch.iloc[-1 - v]
                yield pd.DataFrame({"query": names[q], "id": entry["id"].to_numpy(), "score": score, "cell": entry["cell"].to_numpy()})

    return work


def _top(found: DataFrame, nearest: int) -> DataFrame:
    """The ``nearest`` best rows of each query, ties to the smaller id."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= nearest)


def entries_wanted(entries: DataFrame, cells: Cells, sizes: np.ndarray, nearest: int) -> int:
    """How many entries a query must rank to cover the stated share of its neighbours."""
    names, queries = probes = _sample(entries, int(sizes.sum()), PROBE_ROWS, 2)
    found = entries.mapInPandas(
        _probed(entries.sparkSession.sparkContext.broadcast(probes), nearest),
        "query long, id long, score double, cell long",
    )
    vectors, before, needed = dict(zip(names.tolist(), queries)), {}, []
    for row in _top(found, nearest).select("query", "cell").collect():  # PROBE_ROWS x nearest rows
        if row.query not in before:
            order = cells.taken(vectors[row.query], sizes, int(sizes.sum()))
            before[row.query] = dict(zip(order, np.cumsum(sizes[order]).tolist()))
        needed.append(before[row.query][row.cell])
    return int(np.quantile(needed, COVERED, method="higher")) if needed else 1


def _blocks(sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each cell its first block and over how many blocks it is spread: small cells
    share a block, large ones have several."""
    first, spread = np.zeros(len(sizes), np.int64), np.ones(len(sizes), np.int64)
    block = held = 0
    for cell, size in enumerate(sizes):
        if held and held + size > BLOCK:
            block, held = block + 1, 0
        first[cell] = block
        if size > BLOCK:
            spread[cell] = -(-size // BLOCK)
            block, held = block + int(spread[cell]), 0
        else:
            held += size
    return first, spread


def _aimed(model):
    """Queries to every block that has one of their cells, with those cells."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cells, sizes, first, spread, wanted = model.value
        for batch in batches:
            rows = []
            for query, vector in zip(batch["id"], batch["vector"]):
                aimed: dict[int, list[int]] = {}
                for cell in cells.taken(np.asarray(vector), sizes, wanted):
                    for block in range(first[cell], first[cell] + spread[cell]):
                        aimed.setdefault(block, []).append(cell)
                rows += [(block, query, vector, found) for block, found in aimed.items()]
            yield pd.DataFrame(rows, columns=["block", "id", "vector", "cells"])

    return work


def _ranked(nearest: int):
    def work(entries: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(entries) and len(queries):
            ids, vectors = entries["id"].to_numpy(), np.stack(entries["vector"])
            names, own = np.unique(entries["cell"].to_numpy(), return_inverse=True)
            for at in range(0, len(queries), QUERIES):
                part = queries.iloc[at : at + QUERIES]
                taken = np.array([np.isin(names, c) for c in part["cells"]])
                found.append(
                    _best(part["id"].to_numpy(), np.stack(part["vector"]), ids, vectors, taken[:, own], nearest)
                )
        q, v, s = (np.concatenate(x) for x in zip(*found)) if found else ([], [], [])
        return pd.DataFrame({"query": q, "id": v, "score": s})

    return work


def search(rows: DataFrame, queries: DataFrame, nearest: int = NEAREST) -> DataFrame:
    """The ``nearest`` found neighbours in ``rows`` of every row of ``queries``, both (id,
    vector) as ``usable`` gives them: (query, rank, id, score), rank from 1, ties to the
    smaller id. A query's own id is no neighbour. Every row is indexed; rows that repeat
    an id are neighbours each, a repeated query has its neighbours once. Empty tables
    give no rows.
    """
    spark = rows.sparkSession
    queries = queries.groupBy("id").agg(F.min("vector").alias("vector"))
    total = rows.count()
    if not total:
        return spark.createDataFrame([], "query long, rank int, id long, score double")
    cells = fit(rows, total)
    entries = stage(rows.mapInPandas(_celled(spark.sparkContext.broadcast(cells)), f"{VECTOR}, cell long"), "entries")
    sizes = np.zeros(len(cells.left) * len(cells.right), np.int64)
    for row in entries.groupBy("cell").agg(F.count(F.lit(1)).alias("n")).collect():  # one row per cell
        sizes[row.cell] = row.n
    wanted = entries_wanted(entries, cells, sizes, nearest)
    first, spread = _blocks(sizes)
    model = spark.sparkContext.broadcast((cells, sizes, first, spread, wanted))
    parts = -(-queries.count() // PART_QUERIES) or 1
    places = [(cell, int(first[cell]), int(spread[cell])) for cell in range(len(sizes))]
    places = F.broadcast(spark.createDataFrame(places, "cell long, first long, spread long"))  # as many rows as cells
    held = entries.join(places, "cell").select(
        (F.col("first") + F.pmod(F.xxhash64("id", F.monotonically_increasing_id()), "spread")).alias("block"),
        F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("part"),
        "id",
        "vector",
        "cell",
    )
    spread_out = queries.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")
    aimed = spread_out.mapInPandas(_aimed(model), f"block long, {VECTOR}, cells array<long>")
    aimed = aimed.withColumn("part", F.pmod(F.xxhash64("id"), parts).cast("int"))
    found = (
        held.groupBy("block", "part")
        .cogroup(aimed.groupBy("block", "part"))
        .applyInPandas(_ranked(nearest), "query long, id long, score double")
    )
    return _top(found, nearest).select("query", "rank", "id", "score")


def nearest_neighbours(embeddings: DataFrame) -> DataFrame:
    """Neighbours of every row whose vec_id is divisible by 20, by largest inner product."""
    rows = usable(embeddings, "vec_id", "embedding")
    found = search(rows, rows.filter(F.col("id") % 20 == 0))
    return found.select(
        F.col("query").alias("query_id"), "rank", F.col("id").alias("vec_id"), "score"
    )
