"""Balanced label propagation: documents move to the shards of those they are linked to.

Documents that share a key are linked, each with all others of the key, so in a round all
of them see the same neighbours and ask for the same shard: that which holds most of the
key's documents. What a shard holds beyond its capacity is passed on, key by key, by quotas
from shard to shard; the capacity tightens from round to round. Keys of more than an eighth
of a shard get their places first, each in one shard while one has the room. At the end the
rows above a shard's exact size fill the places left in the others, in order, so apart from
keys that had to be split fewer keys are cut than there are shards.

Rows are numbered from counts per partition, so no task sorts or ranks a whole shard.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.llm.common import stage, whole

SHARDS = 16
ROUNDS = 6
LARGE = 8  # keys with more than this part of a shard's rows are large


def _begin(rows: DataFrame, shards: int) -> DataFrame:
    """A first shard for every row, by its number alone."""
    return rows.withColumn("shard", F.pmod(F.xxhash64("id"), shards).cast("int"))


def _sizes(total: int, shards: int) -> np.ndarray:
    return np.array([total // shards + (s < total % shards) for s in range(shards)])


def _share(*of) -> Column:
    """A number from 0 to 1 by the hash of ``of``."""
    return (F.xxhash64(*of) / F.lit(2.0**64)) + 0.5


def _wishes(linked: DataFrame) -> DataFrame:
    """For each key its rows ``n`` and the shard that holds most of them; a hash decides
    between equals, so that no shard is preferred."""
    held = linked.groupBy("key", "shard").agg(F.count(F.lit(1)).alias("n"))
    best = F.max(F.struct("n", F.xxhash64("key", "shard").alias("tie"), "shard")).alias("best")
    return held.groupBy("key").agg(F.sum("n").alias("n"), best).select("key", "n", F.col("best.shard").alias("shard"))


def _quotas(held: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """How many rows are to move from shard i to shard j: what i holds beyond its capacity,
    over the shards with room, by their room."""
    room = np.maximum(capacity - held, 0)
    return np.outer(np.maximum(held - capacity, 0), room / max(room.sum(), 1))


def _moved(keys: DataFrame, quotas: np.ndarray, held: np.ndarray, turn: int) -> DataFrame:
    """``keys`` (key, n, shard) after keys moved by the quotas, all rows of a key together."""
    shards = len(held)
    chances = np.cumsum(quotas / np.maximum(held, 1)[:, None], axis=1)
    upto = F.array(*(F.array(*(F.lit(float(c)) for c in row)) for row in chances))[F.col("shard")]
    to = F.size(F.filter(upto, lambda c: c <= _share("key", F.lit(turn))))
    return keys.select("key", "n", F.when(to < shards, to).otherwise(F.col("shard")).cast("int").alias("shard"))


def _propagated(linked: DataFrame, capacity: np.ndarray, rounds: int) -> DataFrame:
    """(key, n, shard) of all keys of ``linked``: the shard their rows ask for, moved on while
    a shard holds more than it may. ``capacity``: rows of each shard in the end; before, the
    rounds allow half as much again, a quarter, and so on."""
    keys = stage(_wishes(linked), "keys")
    for turn in range(rounds):
        held = np.zeros(len(capacity))
        for row in keys.groupBy("shard").agg(F.sum("n").alias("n")).collect():  # one row per shard
            held[row.shard] = row.n
        slack = 1 + 0.5 ** (turn + 1) if turn < rounds - 1 else 1
        quotas = _quotas(held, capacity * slack)
        if quotas.any():
            keys = stage(_moved(keys, quotas, held, turn), "keys")
    return keys


def _placed(large: DataFrame, room: np.ndarray) -> DataFrame:
    """(key, to, upto) for large keys: the shard where least room is left beyond a key's rows,
    largest keys first; where none has room for all, the shards with most room, as few as the
    rows need. ``room`` is lowered by what was placed."""
    plans = []
    counts = large.groupBy("key").agg(F.first("n").alias("n")).collect()  # no more than ``LARGE`` a shard
    for row in sorted(counts, key=lambda r: (-r.n, r.key)):
        fits = np.flatnonzero(room >= row.n)
        if len(fits):
            shards = [fits[np.argmin(room[fits])]]
        else:
            shards = np.argsort(-room, kind="stable")
        left, to, upto = row.n, [], []
        for shard in shards:
            part = min(left, int(room[shard]))
            room[shard] -= part
            left -= part
            to.append(int(shard))
            upto.append(1 - left / row.n)
            if not left:
                break
        plans.append((row.key, to, upto))
    return large.sparkSession.createDataFrame(plans, "key string, to array<int>, upto array<double>")


def propagate(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """``rows`` (id, key) with ``shard``, nearly even and no key cut that fits a shard with
    room, and ``rank``: 0 for rows of large keys, 1 for other linked rows, 2 for rows without
    links. Null keys link nothing."""
    rows = stage(_begin(rows, shards), "labels")
    total = rows.count()
    shared = rows.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    shared = stage(shared.filter(F.col("n") > 1).withColumn("large", F.col("n") * LARGE > total / shards), "shared-keys")
    room = _sizes(total, shards)
    plan = _placed(shared.filter("large"), room)
    named = stage(rows.join(shared, "key", "left"), "links")
    at = F.least(F.size(F.filter("upto", lambda u: u <= _share("id"))), F.size("to") - 1)
    large = named.filter("large").select("id", "key").join(F.broadcast(plan), "key")
    linked = named.filter(~F.col("large")).select("id", "key", "shard")
    keys = _propagated(linked, room, rounds).select("key", "shard")
    alone = named.filter(F.col("large").isNull()).select("id", "key", "shard")
    ranked = large.select("id", "key", F.col("to")[at].alias("shard"), F.lit(0).alias("rank"))
    moved = linked.drop("shard").join(keys, "key").select("id", "key", "shard", F.lit(1).alias("rank"))
    return ranked.union(moved).union(alone.withColumn("rank", F.lit(2)))


def settle(labelled: DataFrame, shards: int = SHARDS) -> DataFrame:
    """(id, shard, slot): counts at most one apart, slots of each shard gapless from 0.

    ``labelled`` has id, key, shard and rank. Rows keep their shard up to its exact size,
    lower ranks first and rows of a key together; the others go, in the same order, to
    the places that are left.
    """
    order = ["shard", "rank", "key", "id"]
    parts = int(labelled.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = labelled.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    number = F.monotonically_increasing_id()
    placed = spread.select("id", "shard", number.alias("number"))
    placed = stage(placed.withColumn("part", F.shiftright("number", 33)), "ordered")
    counts = placed.groupBy("part", "shard").agg(F.count(F.lit(1)).alias("n"), F.min("number").alias("first")).collect()
    sizes, before, base = [0] * shards, [], []
    for row in sorted(counts, key=lambda r: (r["part"], r["shard"])):  # one row per partition, and one per shard
        before.append((row["part"], row["shard"], sizes[row["shard"]] - row["first"]))
        sizes[row["shard"]] += row["n"]
    total = sum(sizes)
    wanted = _sizes(total, shards).tolist()
    over = np.cumsum([0] + [max(n - w, 0) for n, w in zip(sizes, wanted)])
    free = np.cumsum([0] + [max(w - n, 0) for n, w in zip(sizes, wanted)])

    spark = labelled.sparkSession
    offsets = spark.createDataFrame(before, "part long, shard int, move long")
    ranked = placed.join(F.broadcast(offsets), ["part", "shard"]).withColumn("place", F.col("number") + F.col("move"))

    def by(values, index) -> Column:
        return F.array(*(F.lit(int(v)).cast("long") for v in values))[index]

    here = by(wanted, F.col("shard"))
    spare = by(over[:-1], F.col("shard")) + F.col("place") - here
    target = sum((F.when(spare >= int(f), 1).otherwise(0) for f in free[1:]), F.lit(0))
    slot = spare - by([*free[:-1], 0], target) + by([*sizes, 0], target)
    stays = F.col("place") < here
    return ranked.select(
        "id",
        F.when(stays, F.col("shard")).otherwise(target).cast("int").alias("shard"),
        F.when(stays, F.col("place")).otherwise(slot).cast("long").alias("slot"),
    )


def shard_rows(rows: DataFrame, shards: int = SHARDS, rounds: int = ROUNDS) -> DataFrame:
    """Shard and slot of every row of ``rows`` (id unique, key).

    Rows of one key are linked; null keys are linked to nothing. Keys with more rows
    than a shard holds are spread over several. An empty table gives no rows.
    """
    return settle(propagate(rows, shards, rounds), shards)


def sharded(docs: DataFrame) -> DataFrame:
    """One row per document: equal texts are linked, the row counts of shards are at most
    one apart. Null texts have no bytes and are linked like empty ones."""
    text = whole()
    narrow = docs.select(
        F.monotonically_increasing_id().alias("id"),
        "doc_id",
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha2(text, 256).alias("key"),
    )
    narrow = stage(narrow, "documents-to-shard")
    found = shard_rows(narrow.select("id", "key"))
    return narrow.join(found, "id").select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
