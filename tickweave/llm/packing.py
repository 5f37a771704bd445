"""Packing documents into training sequences by lexical retrieval.

Every document is cut into token numbers once. A long one fills whole windows by itself,
which need no neighbours; what it has beyond them, and short documents, are dealt to
shards by the min-wise hashes of the document's terms, so that texts with common terms
meet. Each shard has an inverted index with BM25 weights over the whole documents, whose
counts come from the whole corpus. A window starts with a seed document and is filled with the seed's best
unused neighbours; the last one is cut where the window is full, and its rest starts the
next window.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import stage, whole
from tickweave.llm.tokens import encoder

WINDOW = 2048
END = 1  # the number that closes every document
K1, B = 1.2, 0.75  # of BM25
LEAST_IDF = 2.0  # terms in more than about one document of eight say little and are left out
SHARD_TOKENS = 1 << 21  # tokens that one shard's index covers
TASK_TOKENS = 1 << 23  # tokens a task is meant to get

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
    "padded long"
)


CODED = (
    "doc_id long, n long, start long, route long, ids binary, terms binary, counts binary, crcs array<bigint>"
)


def _coded(path: str, window: int):
    """Documents to ``CODED``: all tokens ``n``, the CRC-32 of each whole window, and the
    ``ids`` from ``start`` on, after these windows. ``terms`` and ``counts`` are those of the
    whole document, where ``ids`` is only the end of it. The last row of a task has in
    ``ids`` how many of its documents hold each term, and n -1."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = encoder(path)
        mix = np.random.default_rng(0).permutation(code.size).astype(np.int64)
        holders, held = np.zeros(code.size, np.int64), np.zeros(code.size, bool)
        end = np.array([END], code.kind).tobytes()
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                ids = np.frombuffer(code(text.as_py()) + end, code.kind)
                held[ids] = True
                terms = np.flatnonzero(held)
                held[terms] = False
                holders[terms] += 1
                start = len(ids) - len(ids) % window
                crcs = [_crc32(ids[at : at + window]) for at in range(0, start, window)]
                more = (b"", b"")
                if 0 < start < len(ids):
                    more = (terms.astype(code.kind).tobytes(), np.bincount(ids)[terms].astype("<i8").tobytes())
                rows.append((len(ids), start, _route(terms, mix), ids[start:].tobytes(), *more, crcs))
            yield _code_batch(batch.column("doc_id"), rows)
        yield _code_batch(pa.array([None], pa.int64()), [(-1, 0, 0, holders.astype("<i8").tobytes(), b"", b"", [])])

    return work


def _crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def _route(terms: np.ndarray, mix: np.ndarray) -> int:
    """The terms with the least value in three orders, as one number; near it are documents
    with common terms."""
    route, mixed, size = 0, mix[terms], len(mix)
    for turn in (0, size // 3, 2 * size // 3):
        route = route * size + int(mix[terms[((mixed + turn) % size).argmin()]])
    return route


def _code_batch(doc_id: pa.Array, rows: list[tuple]) -> pa.RecordBatch:
    n, start, route, ids, terms, counts, crcs = list(zip(*rows)) or [()] * 7
    return pa.record_batch(
        {
            "doc_id": doc_id.cast(pa.int64()),
            "n": pa.array(n, pa.int64()),
            "start": pa.array(start, pa.int64()),
            "route": pa.array(route, pa.int64()),
            "ids": pa.array(ids, pa.binary()),
            "terms": pa.array(terms, pa.binary()),
            "counts": pa.array(counts, pa.binary()),
            "crcs": pa.array(crcs, pa.list_(pa.int64())),
        }
    )


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = 0
    for batch in batches:
        for ids in batch.column("ids"):
            total = total + np.frombuffer(ids.as_py(), "<i8")
    if not isinstance(total, int):
        terms = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(terms, pa.int32()), "n": pa.array(total[terms], pa.int64())})


@dataclass
class Corpus:
    """Counts over all documents."""

    idf: np.ndarray
    mean: float  # tokens of a document


@dataclass
class Doc:
    doc_id: int | None
    ids: np.ndarray  # the document's tokens from ``start`` on
    start: int
    tokens: int  # of the whole document
    terms: np.ndarray | None = None  # of the whole document; none: those of ``ids``
    counts: np.ndarray | None = None  # how often each occurs
    at: int = 0  # tokens that are already placed

    def __post_init__(self):
        if self.terms is None:
            self.terms, self.counts = np.unique(self.ids, return_counts=True)


class Index:
    """BM25 inverted index of one shard."""

    def __init__(self, docs: list[Doc], corpus: Corpus):
        self.terms, all_terms, of, weights = [], [], [], []
        for i, doc in enumerate(docs):
            terms, n = doc.terms, doc.counts
            idf = corpus.idf[terms]
            keep = idf >= LEAST_IDF
            terms, n, idf = terms[keep], n[keep], idf[keep]
            norm = K1 * (1 - B + B * doc.tokens / corpus.mean)
            self.terms.append(terms)
            all_terms.append(terms)
            of.append(np.full(len(terms), i))
            weights.append(idf * n * (K1 + 1) / (n + norm))
        by_term = np.concatenate(all_terms) if docs else np.zeros(0, np.int64)
        order = np.argsort(by_term, kind="stable")
        self.of, self.weights = np.concatenate(of)[order], np.concatenate(weights)[order]
        self.first = np.searchsorted(by_term[order], np.arange(len(corpus.idf) + 1))
        self.unused = np.ones(len(docs), bool)

    def neighbours(self, seed: int) -> np.ndarray:
        """Unused documents that share a term with the seed, best first, ties by place."""
        lo, hi = self.first[self.terms[seed]], self.first[self.terms[seed] + 1]
        size = hi - lo
        if not size.sum():
            return np.zeros(0, np.int64)
        at = np.repeat(lo - np.cumsum(size) + size, size) + np.arange(size.sum())
        scores = np.bincount(self.of[at], self.weights[at], len(self.unused))
        found = np.flatnonzero(self.unused & (scores > 0))
        return found[np.argsort(-scores[found], kind="stable")]


class Packer:
    """Fills windows; keeps an open one from shard to shard."""

    def __init__(self, window: int, first_sequence: int):
        self.window, self.sequence = window, first_sequence
        self.open: list[tuple[Doc, int, int]] = []  # document, start, length
        self.used = 0
        self.rows: list[tuple] = []

    def add(self, doc: Doc) -> None:
        """The rest of a document, over as many windows as it needs."""
        while doc.at < len(doc.ids):
            length = min(len(doc.ids) - doc.at, self.window - self.used)
            self.open.append((doc, doc.at, length))
            doc.at += length
            self.used += length
            if self.used == self.window:
                self._close(self.open, self.window)
                self.open, self.used = [], 0

    def pack(self, docs: list[Doc], corpus: Corpus) -> None:
        index = Index(docs, corpus)
        order, at = np.zeros(0, np.int64), 0
        following = 0
        while True:
            while at < len(order) and not index.unused[order[at]]:
                at += 1
            if at < len(order):
                chosen = int(order[at])
            else:
                while following < len(docs) and not index.unused[following]:
                    following += 1
                if following == len(docs):
                    return
                chosen = following
            index.unused[chosen] = False
            before = self.sequence
            empty = not self.used
            self.add(docs[chosen])
            # What stands first in the open window is its seed.
            if empty or self.sequence != before or at >= len(order):
                order, at = index.neighbours(chosen), 0

    def finish(self) -> None:
        """The last open window is cut into powers of two, which need no padding."""
        pieces, left = self.open, self.used
        while left:
            size = 1 << (left.bit_length() - 1)
            taken, room = [], size
            while room:
                doc, start, length = pieces[0]
                part = min(length, room)
                taken.append((doc, start, part))
                room -= part
                pieces = pieces[1:] if part == length else [(doc, start + part, length - part), *pieces[1:]]
            self._close(taken, size)
            left -= size
        self.open, self.used = [], 0

    def _close(self, pieces: list[tuple[Doc, int, int]], padded: int) -> None:
        offset = 0
        for doc, start, length in pieces:
            crc = _crc32(doc.ids[start : start + length])
            self.rows.append((doc.doc_id, doc.start + start, length, crc, doc.tokens, self.sequence, offset, padded))
            offset += length
        self.sequence += 1

    def take(self) -> pa.RecordBatch:
        columns = list(zip(*self.rows)) or [[]] * len(PIECES.split(", "))
        self.rows = []
        names = [f.split()[0] for f in PIECES.split(", ")]
        return pa.record_batch({n: pa.array(c, pa.int64()) for n, c in zip(names, columns)})


def _packed(path: str, corpus, window: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = encoder(path).kind
        packer = Packer(window, TaskContext.get().partitionId() << 40)
        shard, tokens = [], 0
        for batch in batches:
            numbers = (batch.column(c).to_pylist() for c in ("doc_id", "start", "n"))
            of = (batch.column(c) for c in ("ids", "terms", "counts"))
            for ids, terms, counts, doc_id, start, n in zip(*of, *numbers):
                ids = np.frombuffer(ids.as_py(), kind)
                more = ()
                if start:
                    more = np.frombuffer(terms.as_py(), kind), np.frombuffer(counts.as_py(), "<i8")
                shard.append(Doc(doc_id, ids, start, n, *more))
                tokens += len(shard[-1].ids)
                if tokens >= SHARD_TOKENS:
                    packer.pack(shard, corpus.value)
                    yield packer.take()
                    shard, tokens = [], 0
        if shard:
            packer.pack(shard, corpus.value)
        packer.finish()
        yield packer.take()

    return work


def pack(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Pieces of all documents of ``docs`` (doc_id, text) in sequences of ``window`` tokens.

    One row per piece, see ``PIECES``; ``padded`` is the length of its sequence. Every
    token lies in exactly one piece. Only the last sequences of a task are shorter, of
    sizes that are powers of two, so nothing is padded. Null and empty texts are the
    closing number alone; repeated rows and null ids are packed like any others; an
    empty table gives no pieces.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole().alias("text"))
    coded = stage(texts.mapInArrow(_coded(path, window), CODED), "token-ids")
    rows = coded.filter(F.col("n") > 0)
    n_docs, n_tokens, n_rest = rows.agg(F.count(F.lit(1)), F.sum("n"), F.sum(F.col("n") - F.col("start"))).first()
    holders = np.zeros(encoder(path).size)
    counts = coded.filter(F.col("n") < 0).select("ids").mapInArrow(_summed, "term int, n bigint")
    for row in counts.groupBy("term").agg(F.sum("n").alias("n")).collect():  # one row per term of the vocabulary
        holders[row.term] = row.n
    idf = np.log((n_docs - holders + 0.5) / (holders + 0.5))
    corpus = spark.sparkContext.broadcast(Corpus(idf, (n_tokens or 1) / (n_docs or 1)))

    order = ["route", F.crc32("ids"), "doc_id", "start"]
    tasks = max(1, -(-(n_rest or 0) // TASK_TOKENS))
    rest = rows.filter(F.col("start") < F.col("n")).select(
        "doc_id", "n", "start", "route", "ids", "terms", "counts"
    )
    dealt = rest.repartitionByRange(tasks, *order).sortWithinPartitions(*order).drop("route")
    pieces = dealt.mapInArrow(_packed(path, corpus, window), PIECES)
    size = F.lit(window).cast("long")
    alone = rows.select("doc_id", "n", F.posexplode("crcs").alias("number", "crc")).select(
        "doc_id",
        (F.col("number") * size).alias("start"),
        size.alias("length"),
        F.col("crc").alias("ids_crc32"),
        F.col("n").alias("doc_tokens"),
        F.monotonically_increasing_id().bitwiseOR(F.lit(1 << 62)).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
        size.alias("padded"),
    )
    return pieces.union(alone)


def packed(docs: DataFrame, path: str) -> DataFrame:
    return pack(docs, path).drop("padded")
