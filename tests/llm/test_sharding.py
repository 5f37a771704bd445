"""Shards: the law, the slots, and the links that are cut."""

import random
import zlib
from collections import Counter, defaultdict

import pytest

from tickweave.llm import sharding
from tickweave.llm.common import table


def check(rows, docs):
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs
    )
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    counts = [len(slots[s]) for s in range(16)]
    assert set(slots) <= set(range(16)) and max(counts) - min(counts) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_whole_table(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    check(sharding.sharded(docs).collect(), [(r.doc_id, r.text) for r in docs.collect()])


@pytest.mark.parametrize("n", [0, 1, 7, 16, 500])
def test_odd_rows(spark, n):
    rng = random.Random(n)
    rows = [(rng.choice([None, i, 3]), rng.choice([None, "", "hot", f"t{i // 4}", "é" * i])) for i in range(n)]
    docs = spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, shard int, key string")
    check(sharding.sharded(docs).collect(), rows)


def test_links_stay_whole_under_the_quotas(spark):
    rows = [(i, "hot" if i % 3 == 0 else f"group{i // 20}" if i % 2 else f"single{i}") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sharding.sharded(docs).collect()
    check(got, rows)
    texts, where = dict(rows), defaultdict(Counter)
    for r in got:
        where[texts[r.doc_id]][r.shard] += 1
    groups = [c for t, c in where.items() if t.startswith("group")]
    whole = sum(len(c) == 1 for c in groups)
    assert whole >= 0.95 * len(groups)
    # A third of the rows, where a shard holds a sixteenth: a few shards hold nearly all.
    assert sum(n for _, n in where["hot"].most_common(8)) >= 0.95 * sum(where["hot"].values())


def cuts(spark, keys):
    """Keys on more than one shard, as {key: shards}."""
    rows = spark.createDataFrame(list(enumerate(keys)), "id long, key string")
    got, where = sharding.shard_rows(rows).collect(), defaultdict(set)
    counts = Counter(r.shard for r in got)
    assert len(got) == len(keys) and max(counts.values()) - min(counts.values()) <= 1
    for r in got:
        if keys[r.id] is not None:
            where[keys[r.id]].add(r.shard)
    return {key: held for key, held in where.items() if len(held) > 1}


@pytest.mark.parametrize("size,rows", [(8, 3200), (5, 1600), (5, 3000), (2, 20_000)])
def test_every_row_is_linked(spark, size, rows):
    assert len(cuts(spark, [f"k{i // size}" for i in range(rows)])) < 16


def test_large_keys_that_fit_stay_whole(spark):
    shard = 400
    keys = [f"large{i // 180}" for i in range(16 * 180)]  # 16 of 0.45 shard
    keys += [f"k{i // 5}" for i in range(16 * shard - len(keys) - 160)] + [None] * 160
    found = cuts(spark, keys)
    assert not any(k.startswith("large") for k in found) and len(found) < 16


def test_a_key_of_a_third_among_links(spark):
    keys = ["hot"] * 2000 + [f"k{i // 4}" for i in range(4000)]
    found = cuts(spark, keys)
    assert len(found["hot"]) <= 7 and len(found) <= 16
