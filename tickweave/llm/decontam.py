"""Benchmark decontamination by a positional inverted index of the training texts.

The index holds, for each term of the test set that is the rarest of some window, a
posting for every place of the term in the training texts: the document, the position,
and the test terms in the neighbouring positions. Rarity comes from counts over all
documents. A window looks up its rarest term only; moved by the term's offset, the
other terms are intersected with the neighbours of each posting. Postings whose
neighbours lack the second rarest term of every such window are not stored.

The test set is worked through in blocks of a stated size, so that the terms which the
tasks hold stay bounded however large the set is.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import stage, whole

WINDOW = 10
BLOCK_CHARS = 8_000_000  # characters of test items whose terms are held at once
SALTS = 16  # parts of the posting list of one term

# Letters A-Z in lower case; whatever is neither a letter, a digit nor beyond ASCII parts words.
_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)
POSTINGS = "array<struct<term:int,at:int,near:array<int>>>"
WINDOWS = "item string, no_id boolean, term int, offset int, length int, terms array<int>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


@dataclass
class Terms:
    """What tasks need of a block of test items."""

    ids: dict[bytes, int]
    anchor: np.ndarray | None = None  # by term: whether it is the rarest of a window
    single: np.ndarray | None = None  # by term: whether it is all of a window
    pairs: np.ndarray | None = None  # sorted: rarest term x number of terms + second rarest


def _numbered(texts: list[bytes], ids: dict[bytes, int], pad: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Term numbers of all texts (-1: no test term) with ``pad`` times -1 between them,
    and the first place and the number of words of each text."""
    flat, first, size = [-1] * pad, [], []
    for text in texts:
        words = words_of(text)
        first.append(len(flat))
        size.append(len(words))
        flat.extend(map(ids.get, words, repeat(-1)))
        flat.extend(repeat(-1, pad))
    return np.array(flat, np.int32), np.array(first, np.int64), np.array(size, np.int64)


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[int, list[bytes]]]:
    """Row number of the first text and texts, some megabytes at a time."""
    column, at, held, size = batch.column("text").cast(pa.binary()), 0, [], 0
    for i in range(len(column)):
        text = column[i].as_py()
        held.append(text)
        size += len(text)
        if size > 4 << 20:
            yield at, held
            at, held, size = i + 1, [], 0
    if held:
        yield at, held


def _counting(model):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids = model.value.ids
        counts = np.zeros(len(ids) + 1, np.int64)
        for batch in batches:
            for _, texts in _texts(batch):
                found, _, _ = _numbered(texts, ids, 0)
                counts += np.bincount(found + 1, minlength=len(counts))
        seen = np.flatnonzero(counts[1:])
        yield pa.record_batch({"term": pa.array(seen, pa.int32()), "n": pa.array(counts[1:][seen], pa.int64())})

    return work


def _posting(model, window: int):
    reach = window - 1
    around = np.arange(-reach, reach + 1)
    schema = pa.schema(
        [
            ("key", pa.string()),
            ("n_words", pa.int64()),
            ("postings", pa.list_(pa.struct([("term", pa.int32()), ("at", pa.int32()), ("near", pa.list_(pa.int32()))]))),
        ]
    )

    def postings(texts: list[bytes], terms: Terms):
        flat, first, size = _numbered(texts, terms.ids, reach)
        at = np.flatnonzero((flat >= 0) & terms.anchor[flat])
        near = flat[at[:, None] + around]
        code = flat[at].astype(np.int64)[:, None] * len(terms.ids) + near
        useful = terms.single[flat[at]] | (np.isin(code, terms.pairs) & (near >= 0)).any(1)
        at, near = at[useful], near[useful]
        of = np.searchsorted(first, at, "right") - 1
        ends = np.r_[0, np.cumsum(np.bincount(of, minlength=len(texts)))].astype(np.int32)
        nears = pa.ListArray.from_arrays(
            pa.array(np.arange(len(at) + 1) * len(around), pa.int32()), pa.array(near.ravel(), pa.int32())
        )
        one = pa.StructArray.from_arrays(
            [pa.array(flat[at], pa.int32()), pa.array(at - first[of], pa.int32()), nears], ["term", "at", "near"]
        )
        return pa.array(size, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), one)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in _texts(batch):
                size, found = postings(texts, model.value)
                keys = batch.column("key").slice(start, len(texts))
                yield pa.RecordBatch.from_arrays([keys.cast(pa.string()), size, found], schema=schema)

    return work


def _windows(items: list, window: int) -> list[tuple[str | None, list[bytes]]]:
    found = []
    for item in items:
        words = words_of((item.text or "").encode())
        name = None if item.item_id is None else str(item.item_id)
        if words:
            found += [(name, words[i : i + window]) for i in range(max(1, len(words) - window + 1))]
    return found


def _index(docs: DataFrame, items: list, window: int) -> tuple[DataFrame, DataFrame]:
    """The index of one block of items: documents with their postings, and windows."""
    spark = docs.sparkSession
    windows = _windows(items, window)
    ids = {word: i for i, word in enumerate(sorted({w for _, words in windows for w in words}))}
    counted = docs.mapInArrow(_counting(spark.sparkContext.broadcast(Terms(ids))), "term int, n bigint")
    counts = np.zeros(len(ids) + 1, np.int64)
    for row in counted.groupBy("term").agg(F.sum("n").alias("n")).collect() if ids else []:
        counts[row.term] = row.n

    anchor, single = np.zeros(len(ids) + 1, bool), np.zeros(len(ids) + 1, bool)
    pairs, rows = set(), []
    for name, words in windows:
        terms = [ids[w] for w in words]
        rarest, *others = sorted(set(terms), key=lambda t: (counts[t], t))
        anchor[rarest] = True
        if others:
            pairs.add(rarest * len(ids) + others[0])
        else:
            single[rarest] = True
        rows.append((name, name is None, rarest, terms.index(rarest), len(terms), terms))
    model = Terms(ids, anchor, single, np.array(sorted(pairs), np.int64))
    posted = docs.mapInArrow(
        _posting(spark.sparkContext.broadcast(model), window), f"key string, n_words bigint, postings {POSTINGS}"
    )
    return stage(posted, "postings"), spark.createDataFrame(rows, WINDOWS)


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> tuple[DataFrame, DataFrame]:
    """``docs`` has ``key`` and ``text``; ``benchmark`` has item_id and text. Returns

    * key and n_words, a row per row of ``docs``;
    * matches: key, item, no_id, start and length in words, and kind. ``exact`` is the
      window word by word; ``near`` has all its terms among the words around its
      rarest term, in any order, and names the place of this term with length 1.

    Null and empty texts have no words and match nothing; items without words have no
    windows. Repeated rows give repeated results.
    """
    texts = docs.select(F.col("key").cast("string").alias("key"), whole().alias("text"))
    items = benchmark.select("item_id", "text")
    chars = items.agg(F.sum(F.length(whole()))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS) or 1
    sizes, matches = None, None
    for block in range(blocks):
        own = items.filter(F.pmod(F.xxhash64("item_id", "text"), blocks) == block).collect()
        posted, windows = _index(texts, own, window)
        sizes = posted.select("key", "n_words") if sizes is None else sizes
        found = _lookup(posted, windows, window)
        matches = found if matches is None else matches.union(found)
    return sizes, matches


def _lookup(posted: DataFrame, windows: DataFrame, window: int) -> DataFrame:
    index = stage(
        posted.select("key", F.inline("postings")).repartition("term", F.pmod(F.xxhash64("key"), SALTS)),
        "inverted-index",
    )
    here = F.slice("near", F.lit(window) - F.col("offset"), F.col("length"))
    exact = here == F.col("terms")
    near = F.size(F.array_except("terms", "near")) == 0
    found = index.join(windows, "term").filter(exact | near)
    return found.select(
        "key",
        "item",
        "no_id",
        F.when(exact, F.col("at") - F.col("offset")).otherwise(F.col("at")).alias("start"),
        F.when(exact, F.col("length")).otherwise(1).alias("length"),
        F.when(exact, F.lit("exact")).otherwise(F.lit("near")).alias("kind"),
    )


def contamination(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document: words, words inside exact matches, and the items. Items
    without an id make words hit, but are neither counted nor listed."""
    numbered = docs.select("doc_id", "text").withColumn("key", F.monotonically_increasing_id())
    numbered = numbered.withColumn("key", F.concat_ws(":", "key", F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    sizes, matches = find_contamination(numbered, benchmark)
    places = F.transform("places", lambda p: F.sequence(p["start"], p["start"] + p["length"] - 1))
    hits = (
        matches.filter(F.col("kind") == "exact")
        .groupBy("key")
        .agg(F.collect_set(F.struct("start", "length")).alias("places"), F.collect_set("item").alias("items"))
        .select("key", F.size(F.array_distinct(F.flatten(places))).cast("long").alias("n_hit"), "items")
    )
    none = F.array().cast("array<string>")
    return (
        sizes.join(hits, "key", "left")
        .withColumn("items", F.array_sort(F.coalesce("items", none)))
        .select(
            F.split("key", ":")[1].try_cast("long").alias("doc_id"),
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
            F.size("items").cast("long").alias("n_items"),
            F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
        )
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a window of ``benchmark`` word by word."""
    named = docs.select(F.sha2(whole(), 256).alias("key"), "text")
    _, matches = find_contamination(named, benchmark)
    bad = matches.filter(F.col("kind") == "exact").select(F.col("key").alias("tw text key")).distinct()
    return docs.join(bad, F.sha2(whole(), 256) == F.col("tw text key"), "left_anti")
