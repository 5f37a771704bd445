"""Near duplicates by SimHash fingerprints and a binary trie self-join.

The trie is walked inside cells. A cell is a value of one of budget + 1 blocks of the
fingerprint: two fingerprints within the budget agree in one block, which is then the
top of a trie of turned fingerprints, so no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm import trie
from tickweave.llm.common import stage, whole
from tickweave.llm.components import components

SEED = 42
CELL_ROWS = 40_000  # fingerprints of one cell that one task compares
BATCH_ROWS = 200_000  # fingerprints a task holds at once, cells kept whole


@dataclass(frozen=True)
class Method:
    """``shingle``: words of a shingle. ``budget``: most bits in which linked
    fingerprints differ."""

    shingle: int = 3
    budget: int = 3


EXACT = Method()


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 of every shingle; fewer words than a shingle has are one shingle."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = map(b" ".join, zip(*(words[i:] for i in range(size)))) if len(words) > size else [b" ".join(words)]
    digest = xxhash.xxh64_intdigest
    return np.array([digest(s, SEED) for s in joined], np.uint64)


def majority(hashes: np.ndarray) -> np.uint64:
    """A bit is set where more than half of the hashes have it."""
    if not len(hashes):
        return np.uint64(0)
    ones = np.zeros(64, np.int64)
    for part in np.array_split(hashes, len(hashes) // 4096 + 1):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int32)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.uint64)[0]


def _printed(method: Method):
    def work(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            prints = [majority(shingle_hashes(text.as_py() or b"", method.shingle)) for text in texts.cast(pa.binary())]
            yield pa.array([int(p).to_bytes(8, "big") for p in prints], pa.binary())

    return F.arrow_udf(work, "binary")


def with_fingerprints(docs: DataFrame, method: Method, text: str = "text") -> DataFrame:
    """``docs`` as ``row`` (a struct of all its columns) with ``fingerprint``, big-endian
    bytes. Null and empty texts have the fingerprint zero."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    return docs.select(row.alias("row"), _printed(method)(whole(text)).alias("fingerprint"))


def _cells(prints: DataFrame, method: Method) -> DataFrame:
    """Distinct fingerprints in their cells: (cell, fingerprint, key). ``key`` has the
    block that makes the cell in front."""
    block = 64 // (method.budget + 1)
    number = _number("fingerprint")

    def turned(i: int) -> Column:
        left, right = F.shiftleft(number, i * block), F.shiftrightunsigned(number, 64 - i * block)
        return left.bitwiseOR(right) if i else number

    each = F.array(*(F.struct(F.lit(i).alias("block"), turned(i).alias("key")) for i in range(method.budget + 1)))
    rows = prints.select("fingerprint").distinct().select("fingerprint", F.explode(each).alias("at"))
    value = F.shiftrightunsigned("at.key", 64 - block)
    return rows.select(
        F.xxhash64("at.block", value).alias("cell"),
        "fingerprint",
        F.unhex(F.lpad(F.hex("at.key"), 16, "0")).alias("key"),
    )


def _number(column: str) -> Column:
    return F.conv(F.hex(column), 16, -10).cast("long")


def _apart(a: str, b: str) -> Column:
    return F.bit_count(_number(a).bitwiseXOR(_number(b)))


def _split(cells: DataFrame, method: Method, limit: int) -> tuple[DataFrame, DataFrame | None]:
    """Cells with (cell, key, fingerprint, group), those beyond ``limit`` rows cut up, and
    links found on the way.

    All rows of a large cell within the budget of its smallest key, the hub, are linked
    to it; as a ``group`` they need not be compared with each other. If others are left,
    the cell becomes a grid: each row has a number below n and goes to the n cells that
    pair it with every number, so every pair of rows meets and no task gets more rows
    than the limit.
    """
    alone = F.lit(-1).cast("long").alias("group")
    hub = F.min(F.struct("key", "fingerprint")).alias("hub")
    large = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), hub).filter(F.col("rows") > limit)
    large = stage(large, "large-cells")
    if large.isEmpty():
        return cells.select("cell", "key", "fingerprint", alone), None
    small = cells.join(large, "cell", "left_anti").select("cell", "key", "fingerprint", alone)
    hot = cells.join(large, "cell").withColumn("near", _apart("key", "hub.key") <= method.budget)
    hot = stage(hot, "hot")
    links = hot.filter("near").select(F.col("fingerprint").alias("a"), F.col("hub.fingerprint").alias("b"))
    n = F.ceil(F.col("rows") * 2 / F.lit(limit)).cast("int")
    grid = (
        hot.join(hot.filter(~F.col("near")).select("cell").distinct(), "cell", "left_semi")
        .withColumn("own", F.pmod(F.xxhash64("key"), n).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
        .select(
            F.xxhash64("cell", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
            "key",
            "fingerprint",
            F.when(F.col("near"), F.shiftrightunsigned("cell", 1)).otherwise(F.lit(-1)).alias("group"),
        )
    )
    return small.union(grid), links


def _compare(method: Method):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(map(len, held)) < BATCH_ROWS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            cell = rows["cell"].to_numpy()
            whole_cells = int(np.searchsorted(cell, cell[-1]))  # the last cell may go on
            yield _forest(rows.slice(0, whole_cells), method)
            held = rows.slice(whole_cells).to_batches()
        if held:
            yield _forest(pa.Table.from_batches(held), method)

    return work


def _forest(rows: pa.Table, method: Method) -> pa.RecordBatch:
    keys = np.frombuffer(b"".join(rows["key"].to_pylist()), ">u8").astype(np.uint64).reshape(len(rows), 1)
    a, b = trie.forest(rows["cell"].to_numpy(), keys, rows["group"].to_numpy(), method.budget)
    prints = rows["fingerprint"].combine_chunks()
    return pa.record_batch({"a": prints.take(pa.array(a)), "b": prints.take(pa.array(b))})


def links(prints: DataFrame, method: Method, limit: int = CELL_ROWS) -> DataFrame:
    """Links (a, b) between distinct fingerprints within the budget: not every such pair,
    but enough to connect all that are connected."""
    cells, more = _split(_cells(prints, method), method, limit)
    # A cell of one row has nothing to compare; the sort brings a cell's rows together.
    rows = cells.repartition("cell").sortWithinPartitions("cell")
    found = rows.mapInArrow(_compare(method), "a binary, b binary")
    return found if more is None else found.union(more)


def classes(prints: DataFrame, method: Method, limit: int = CELL_ROWS) -> DataFrame:
    """(fingerprint, root) of every distinct fingerprint of the table ``prints``; one root
    for all that links reach. Documents of one fingerprint are in one class."""
    up = components(links(prints, method, limit)).withColumnRenamed("a", "fingerprint")
    every = prints.select("fingerprint").distinct()
    return every.join(up, "fingerprint", "left").select(
        "fingerprint", F.coalesce("root", "fingerprint").alias("root")
    )


def near_duplicates(docs: DataFrame, limit: int = CELL_ROWS) -> DataFrame:
    """doc_id, fingerprint (hex) and component_id: the smallest doc_id of all documents
    reached by links of 3 or fewer differing bits.

    One row per row of ``docs``. Texts without a word have the fingerprint zero and
    link like others. A null doc_id is never a component_id, unless all of a component
    are null. An empty table gives no rows.
    """
    found = with_fingerprints(docs.select("doc_id", "text"), EXACT)
    prints = stage(found.select("row.doc_id", "fingerprint"), "fingerprints")
    roots = stage(classes(prints, EXACT, limit), "classes")
    least = prints.groupBy("fingerprint").agg(F.min("doc_id").alias("least"))
    ids = roots.join(least, "fingerprint").groupBy("root").agg(F.min("least").alias("component_id"))
    named = roots.join(ids, "root").select("fingerprint", "component_id")
    return prints.join(named, "fingerprint").select(
        "doc_id", F.lower(F.hex("fingerprint")).alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(docs: DataFrame, method: Method = EXACT, limit: int = CELL_ROWS) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``: that with the smallest
    doc_id, nulls last, and one of them if several have it. Texts without a word are one
    component; extra columns are kept, an empty table gives no rows."""
    numbered = docs.withColumn("tw row number", F.monotonically_increasing_id())
    prints = stage(with_fingerprints(numbered, method), "fingerprints")
    rank = F.struct(F.col("row.doc_id").isNull(), "row.doc_id", "row.`tw row number`")
    best = prints.groupBy("fingerprint").agg(F.min(rank).alias("best"))
    roots = classes(prints, method, limit).join(best, "fingerprint")
    kept = roots.groupBy("root").agg(F.min("best").alias("best")).select("best.`tw row number`")
    rows = prints.select(F.col("row.`tw row number`").alias("tw row number"), "row")
    return rows.join(kept, "tw row number", "left_semi").select(*(F.col(f"row.`{c}`").alias(c) for c in docs.columns))
