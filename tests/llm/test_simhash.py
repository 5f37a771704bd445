"""Fingerprints, links and components against plain Python loops."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tickweave.llm import simhash, trie
from tickweave.llm.common import table


def plain_print(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([b" ".join(words)] if words else [])
    ones = [0] * 64
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        for bit in range(64):
            ones[bit] += h >> bit & 1
    return sum(1 << bit for bit in range(64) if ones[bit] * 2 > len(shingles))


def plain_components(rows):
    prints = [(i, plain_print(t)) for i, t in rows]
    distinct = sorted({p for _, p in prints})
    root = {p: p for p in distinct}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    values = np.array(distinct, np.uint64)
    for k, p in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(values[:k] ^ np.uint64(p)) <= 3):
            root[find(p)] = find(distinct[j])
    least = {}
    for i, p in prints:
        if i is not None:
            least[find(p)] = min(i, least.get(find(p), i))
    return sorted(((i, f"{p:016x}", least.get(find(p))) for i, p in prints), key=str)


def got(df):
    return sorted(((r.doc_id, r.fingerprint, r.component_id) for r in df.collect()), key=str)


@pytest.mark.parametrize("limit", [simhash.CELL_ROWS, 3])
def test_whole_table(spark, sf_dir, limit):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert got(simhash.near_duplicates(docs, limit)) == plain_components(rows)


@pytest.mark.parametrize("limit", [simhash.CELL_ROWS, 4])
def test_odd_rows(spark, limit):
    rng = random.Random(1)
    base = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(400)) for _ in range(3)]
    rows = [(None, base[0]), (7, base[0]), (7, base[0]), (3, base[1]), (4, None), (5, ""), (9, "  \n"), (11, "one")]
    rows += [(20 + i, base[i % 3] + f" tail{i}") for i in range(40)]
    rows += [(100, "É é É " * 50_000), (101, "one"), (102, "ONE two")]
    docs = spark.createDataFrame([(*r, "x", b"y") for r in rows], "doc_id long, text string, bands string, fingerprint binary")
    assert got(simhash.near_duplicates(docs, limit)) == plain_components(rows)
    assert simhash.near_duplicates(docs.limit(0)).collect() == []
    kept = simhash.drop_near_duplicates(docs, limit=limit)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(7) == 1 and None not in ids and 101 not in ids and 9 not in ids and 102 in ids


@pytest.mark.parametrize("words,budget", [(1, 3), (2, 9)])
def test_trie_against_all_pairs(words, budget):
    rng = np.random.default_rng(words)
    centres = rng.integers(0, 1 << 63, (30, words), dtype=np.uint64)
    keys = np.repeat(centres, 20, 0)
    for _ in range(3):
        keys[np.arange(600), rng.integers(0, words, 600)] ^= np.uint64(1) << rng.integers(0, 64, 600).astype(np.uint64)
    cell, group = rng.integers(0, 4, 600), np.full(600, -1)
    a, b = trie.forest(cell, keys, group, budget)
    assert (np.bitwise_count(keys[a] ^ keys[b]).sum(1) >= 0).all() and (cell[a] == cell[b]).all()
    near = (np.bitwise_count(keys[:, None] ^ keys[None]).sum(2) <= budget) & (cell[:, None] == cell[None])

    def labels(pairs):
        label = list(range(600))
        for _ in range(600):
            before = list(label)
            for x, y in pairs:
                label[x] = label[y] = min(label[x], label[y])
            if label == before:
                return label
        return label

    assert labels(list(zip(a, b))) == labels(list(zip(*np.nonzero(near))))


def test_one_row_of_each_component_stays(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    kept = sorted(r.doc_id for r in simhash.drop_near_duplicates(docs).collect())
    assert kept == sorted({c for _, _, c in plain_components(rows)}) and len(kept) < len(rows)


def test_hash_is_that_of_spark(spark):
    assert spark.range(1).select(F.xxhash64(F.lit("a b c"))).first()[0] % (1 << 64) == xxhash.xxh64_intdigest(b"a b c", 42)
