"""Pages and positions against plain sorting."""

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickweave.functions import scalars as fn
from tickweave.operators import paging

DAY = datetime(2024, 1, 1)
SCHEMA = "secid string, tradeno bigint, trade_ts timestamp_ntz, boardid string"


def make(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def some_trades(seed, n, hot=0.4, timeless=0.05):
    """Few instruments, one of them with a third of the rows; times and whole
    rows that repeat."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        secid = "HOT" if rng.random() < hot else rng.choice(["A", "B", "C"])
        ts = None
        if rng.random() >= timeless:
            ts = DAY + timedelta(minutes=rng.choice([0, 0, 0, 7, 61, 125, 600]))
        rows.append((secid, rng.randrange(n // 3), ts, rng.choice("xy")))
    return rows + [("HOT", 1, DAY, "x")] * (n // 3)


def in_order(rows, reverse=False):
    def key(row):
        secid, tradeno, ts, boardid = row
        late = ts is None
        if reverse:
            when = 0 if late else -(ts - DAY).total_seconds()
            return (late, when, -tradeno, secid, boardid)
        return (late, ts or DAY, tradeno, secid, boardid)

    return sorted(rows, key=key)


@pytest.mark.parametrize("reverse", [True, False])
@pytest.mark.parametrize("start, limit", [(0, 10), (35, 40), (190, 25), (390, 50), (9999, 5)])
def test_page(spark, reverse, start, limit):
    rows = some_trades(1, 300)
    trades = make(spark, rows)
    wanted = Counter(in_order(rows, reverse)[start : start + limit])
    shallow = paging.trades_page(trades, limit, start, reverse)
    assert Counter(tuple(r) for r in shallow.collect()) == wanted
    for sort_rows in (0, 40, 10_000):
        deep = paging.trades_page(trades, limit, start, reverse, 0, sort_rows)
        assert Counter(tuple(r) for r in deep.collect()) == wanted


@pytest.mark.parametrize("top_k_rows, sort_rows", [(0, 10_000), (200, 10_000), (0, 0)])
def test_page_is_in_order(spark, top_k_rows, sort_rows):
    rows = some_trades(2, 100)
    page = paging.trades_page(make(spark, rows), 50, 10, True, top_k_rows, sort_rows).collect()
    assert [tuple(r) for r in page] == in_order(rows, reverse=True)[10:60]


def test_page_assignment(spark):
    rows = some_trades(3, 400)
    wanted = Counter()
    for secid in {r[0] for r in rows}:
        own = in_order([(r[0], r[1], r[2], "") for r in rows if r[0] == secid])
        for position, (_, tradeno, ts, _) in enumerate(own):
            wanted[(secid, ts, tradeno, position // 25)] += 1
    found = paging.page_assignment(make(spark, rows), 25)
    assert Counter(tuple(r) for r in found.collect()) == wanted


def test_page_assignment_over_all(spark):
    rows = some_trades(4, 300)
    wanted = Counter()
    plain = in_order([(r[0], r[1], r[2], "") for r in rows])
    for position, (secid, tradeno, ts, _) in enumerate(plain):
        wanted[(secid, ts, tradeno, position // 40)] += 1
    found = paging.page_assignment(make(spark, rows), 40, per_symbol=False)
    assert Counter(tuple(r) for r in found.collect()) == wanted


def test_a_hot_instrument_is_cut_into_pieces(spark):
    trades = spark.range(40_000).select(
        F.lit("HOT").alias("secid"),
        F.col("id").alias("tradeno"),
        F.lit(DAY).cast("timestamp_ntz").alias("trade_ts"),
    )
    adaptive = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        order = [F.col("tradeno").asc_nulls_last()]
        placed = paging.with_positions(trades, order, ("secid",))
        assert placed.filter("position != tradeno").count() == 0
        plan = placed._jdf.queryExecution().optimizedPlan().toString()
        assert "_piece" in plan
        pieces = placed.select(F.spark_partition_id().alias("p")).groupBy("p").count()
        assert pieces.agg(F.max("count")).first()[0] < 40_000 * 0.6
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", adaptive)


@pytest.mark.parametrize("n, pages", [(1, 1), (4, 1), (5, 2), (9, 2), (10, 3), (11, 3)])
def test_page_count(spark, n, pages):
    trades = make(spark, [("A", i, DAY, "x") for i in range(n)])
    (row,) = paging.page_count(trades, 5).collect()
    assert (row.trades, row.pages) == (n, pages)
    (row,) = paging.page_count(trades, 5, per_symbol=False).collect()
    assert row.pages == pages


def test_latest_of_one_symbol(spark):
    rows = some_trades(5, 200, timeless=0)
    found = paging.latest_trades_symbol(make(spark, rows), "HOT", 7).collect()
    own = [r for r in in_order(rows, reverse=True) if r[0] == "HOT"]
    assert [tuple(r) for r in found] == own[:7]


def test_pages_do_not_depend_on_the_session_zone(spark):
    """02:30 of that day does not exist in that zone."""
    start = datetime(2024, 3, 10, 1)
    rows = [("A", i, start + timedelta(minutes=10 * i), "x") for i in range(18)]
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        trades = make(spark, rows)
        page = paging.trades_page(trades, 6, 7, False, 0, 0)
        assert sorted(r.tradeno for r in page.collect()) == list(range(7, 13))
        texts = trades.select(fn.format_time(F.col("trade_ts")).alias("t")).collect()
        assert [r.t for r in texts] == [str(r[2]) for r in rows]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_extreme_dates(spark):
    ends = [datetime(9999, 12, 31, 23, 59, 59, 999_999), datetime(9999, 12, 31, 23), datetime(1, 1, 1)]
    rows = [("A", i, ts, "x") for i, ts in enumerate([*ends, *[DAY + timedelta(hours=h) for h in range(30)]])]
    for reverse in (True, False):
        for sort_rows in (0, 10_000):
            page = paging.trades_page(make(spark, rows), 33, 0, reverse, 0, sort_rows).collect()
            assert [tuple(r) for r in page] == in_order(rows, reverse)


def test_copies_of_one_row_are_cut_into_pieces(spark):
    trades = spark.range(40_000).select(
        F.lit("HOT").alias("secid"), F.lit(1).alias("tradeno"), F.lit(DAY).cast("timestamp_ntz").alias("trade_ts")
    )
    placed = paging.with_positions(trades, [F.col("tradeno").asc()], ("secid",))
    assert {r.position for r in placed.collect()} == set(range(40_000))
    plan = placed._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression" not in plan  # the rows were shuffled once, before they were written
