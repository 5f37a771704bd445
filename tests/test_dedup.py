"""The seen-set against a plain loop, and the two ways of dropping copies."""

import random
from collections import Counter
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tickweave.operators import dedup, selection

KEYS = "secid string, tradeno bigint"


def plain_seen(history, cap):
    """Numbers added one by one; above the cap the smallest goes."""
    held = {}
    for secid, tradeno in history:
        numbers = held.setdefault(secid, set())
        numbers.add(tradeno)
        if len(numbers) > cap:
            numbers.remove(min(numbers))
    return {(s, n) for s, numbers in held.items() for n in numbers}


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("cap", [1, 5, 40, 10_000])
def test_bounded_seen_set(spark, seed, cap):
    rng = random.Random(seed)
    history = [
        ("HOT" if rng.random() < 0.5 else rng.choice("AB"), rng.randrange(-50, 300))
        for _ in range(400)
    ]
    found = dedup.bounded_seen_set(spark.createDataFrame(history, KEYS), cap)
    rows = [tuple(r) for r in found.collect()]
    assert len(rows) == len(set(rows))
    assert set(rows) == plain_seen(history, cap)


@pytest.mark.parametrize("partitions", ["1", "7", "8", "200"])
def test_slices_do_not_change_the_set(spark, partitions):
    history = [("HOT", i % 611) for i in range(2000)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        found = dedup.bounded_seen_set(spark.createDataFrame(history, KEYS), 100)
        assert {r.tradeno for r in found.collect()} == set(range(511, 611))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_mark_batches_one_after_the_other(spark):
    rng = random.Random(9)
    history, seen = [], spark.createDataFrame([], KEYS)
    for _ in range(3):
        batch = [(rng.choice("AB"), rng.randrange(100)) for _ in range(60)]
        history += batch
        marked = dedup.mark_batch(seen, spark.createDataFrame(batch, KEYS), 20)
        seen = spark.createDataFrame(marked.collect(), KEYS)
        assert {tuple(r) for r in seen.collect()} == plain_seen(history, 20)
    counts = {r.secid: r.held for r in dedup.seen_counts(seen).collect()}
    assert counts == {"A": 20, "B": 20}


def test_copies_inside_a_batch_stay(spark):
    batch = [("A", 1), ("A", 1), ("A", 2), ("B", 2), ("B", 1)]
    found = dedup.filter_new_trades(
        spark.createDataFrame(batch, KEYS), spark.createDataFrame([("A", 2), ("B", 1)], KEYS)
    )
    assert Counter(tuple(r) for r in found.collect()) == Counter(
        {("A", 1): 2, ("B", 2): 1}
    )


def test_a_hot_key_of_the_anti_join_is_split(spark):
    """Beyond the broadcast threshold, one key with most rows meets many tasks."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10KB",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        hot = F.col("id") % 10 < 8
        trades = spark.range(0, 200_000, 1, 16).select(
            F.when(hot, "HOT").otherwise("A").alias("secid"),
            F.when(hot, 0).otherwise(F.col("id")).alias("tradeno"),
            F.sha2(F.col("id").cast("string"), 256).alias("boardid"),
        )
        seen = spark.range(0, 200_000, 3).select(
            F.lit("A").alias("secid"), F.col("id").alias("tradeno")
        )
        found = dedup.filter_new_trades(trades, seen)
        rows = found.collect()
        assert len(rows) == 160_000 + sum(
            1 for i in range(200_000) if i % 10 >= 8 and i % 3
        )
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def test_dedup_keeps_the_earliest(spark):
    rows = [
        ("A", 1, datetime(2024, 1, 2), "x"),
        ("A", 1, datetime(2024, 1, 1), "y"),
        ("A", 1, datetime(2024, 1, 1), "x"),
        ("A", 1, None, "a"),
        ("B", 1, None, "b"),
    ]
    trades = spark.createDataFrame(
        rows, "secid string, tradeno bigint, trade_ts timestamp_ntz, boardid string"
    )
    found = {tuple(r) for r in dedup.dedup_trades(trades).collect()}
    assert found == {rows[2], rows[4]}


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    trades = spark.range(1000).select(
        F.when(F.col("id") < 900, "").otherwise("A").alias("secid"),
        F.greatest(F.col("id") - 900, F.lit(0)).alias("tradeno"),
        F.lit(datetime(2024, 1, 1)).cast("timestamp_ntz").alias("trade_ts"),
    )
    assert dedup.dedup_trades(trades).count() == 101
    plan = dedup.dedup_trades(trades)._jdf.queryExecution().executedPlan().toString()
    shuffle = plan.index("Exchange")
    assert "WindowGroupLimit" in plan[shuffle:] and "Partial" in plan[shuffle:]


def test_symbols(spark):
    trades = spark.createDataFrame([("A", 1), ("B", 2), ("C", 3), ("A", 1)], KEYS)

    def numbers(wanted):
        return sorted(r.tradeno for r in selection.filter_symbols(trades, wanted).collect())

    assert numbers(None) == [1, 1, 2, 3]
    assert numbers(["A", "C", "A"]) == [1, 1, 3]
    assert numbers([]) == []
    table = spark.createDataFrame([("B",), ("B",), ("C",)], "secid string")
    assert numbers(table) == [2, 3]


def test_a_long_symbol_table_is_not_broadcast(spark, monkeypatch):
    trades = spark.createDataFrame([("A", 1), ("B", 2)], KEYS)
    table = spark.createDataFrame([("B",), ("C",)], "secid string")
    small = selection.filter_symbols(trades, table)
    assert "strategy=broadcast" in small._jdf.queryExecution().logical().toString()
    monkeypatch.setattr(selection, "BROADCAST_SYMBOLS", 1)
    large = selection.filter_symbols(trades, table)
    assert "strategy=broadcast" not in large._jdf.queryExecution().logical().toString()
    assert [r.tradeno for r in large.collect()] == [2]
