"""Windows, the cycle log and its counters against plain loops."""

import random
from collections import defaultdict
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tickweave.functions import scalars as fn
from tickweave.operators import cursor, cycles
from tickweave.schemas import CYCLE

START = datetime(2024, 1, 1, 9, 0, 0)


def plain_windows(start, now, minutes=5):
    """One cycle after the other, as long as the gap is too wide."""
    windows = []
    while True:
        gap = int((now - start).total_seconds()) // 60 if now > start else 0
        till = start + timedelta(minutes=minutes) if gap > minutes else now
        windows.append((start, till))
        if till == now:
            return windows
        start = till


GAPS = [-3600, -1, 0, 59, 299, 300, 359, 360, 361, 659, 660, 1050, 3599, 86_400]


def test_windows_of_the_driver():
    for gap in [*GAPS, *range(0, 20_000, 37)]:
        now = START + timedelta(seconds=gap)
        wanted = plain_windows(START, now)
        assert cycles.whole_windows(START, now) == len(wanted) - 1
        assert cycles.next_till(START, now) == wanted[0][1]


@pytest.mark.parametrize("minutes", [1, 5, 7])
def test_windows_of_a_table(spark, minutes):
    bounds = [
        (i, START + timedelta(microseconds=170), START + timedelta(seconds=gap, microseconds=m))
        for i, (gap, m) in enumerate((g, m) for g in GAPS for m in (0, 170, 999_999))
    ]
    frame = spark.createDataFrame(
        bounds, "run_id int, from_ts timestamp_ntz, now_ts timestamp_ntz"
    )
    found = defaultdict(list)
    for r in cycles.catchup_windows(frame, minutes).orderBy("run_id", "window_id").collect():
        assert r.window_id == len(found[r.run_id])
        found[r.run_id].append((r.from_ts, r.till_ts))
    for run, start, now in bounds:
        assert found[run] == plain_windows(start, now, minutes)


def test_documented_window_counts(spark):
    for gap, count in [(0, 1), (359, 1), (360, 2), (1050, 4), (-10, 1)]:
        now = START + timedelta(seconds=gap)
        assert cycles.whole_windows(START, now) + 1 == count


def test_micros_between_ignores_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        pairs = [
            (datetime(2024, 3, 9, 12), datetime(2024, 3, 10, 12, 0, 0, 5)),
            (datetime(2024, 11, 3, 12), datetime(2024, 11, 2, 23, 59, 59, 999_999)),
        ]
        frame = spark.createDataFrame(pairs, "a timestamp_ntz, b timestamp_ntz")
        got = frame.select(fn.micros_between(F.col("a"), F.col("b")).alias("m")).collect()
        assert [r.m for r in got] == [
            (b - a) // timedelta(microseconds=1) for a, b in pairs
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("seed", range(3))
def test_cycle_log(spark, seed):
    """Each cycle fetches a closed window, drops what is seen, marks the rest."""
    rng = random.Random(seed)
    start = START + timedelta(microseconds=700_000)
    now = START + timedelta(minutes=38, seconds=20, microseconds=1)
    trades = [
        (
            "HOT" if rng.random() < 0.5 else rng.choice("AB"),
            rng.randrange(60),
            START + timedelta(minutes=rng.randrange(-3, 45), seconds=rng.choice([0, 0, 9])),
        )
        for _ in range(500)
    ] + [("HOT", 0, START + timedelta(minutes=m)) for m in range(0, 40, 5) for _ in range(9)]
    seen = [("A", n) for n in range(10)] + [("HOT", 5), ("HOT", 5)]
    wanted, known = [], set(seen)
    for number, (a, b) in enumerate(plain_windows(start, now)):
        lo, hi = a.replace(microsecond=0), b.replace(microsecond=0)
        fetched = [t for t in trades if lo <= t[2] <= hi]
        fresh = [t for t in fetched if t[:2] not in known]
        known |= {t[:2] for t in fresh}
        wanted.append(
            (number, a, b, len(fresh), len(fetched) - len(fresh), len(fetched) // 7 + 1)
        )
    log = cycles.cycle_log(
        spark.createDataFrame(trades, "secid string, tradeno bigint, trade_ts timestamp_ntz"),
        spark.createDataFrame(seen, "secid string, tradeno bigint"),
        start,
        now,
        page_size=7,
    )
    assert [tuple(r) for r in log.orderBy("window_id").collect()] == wanted


def log_of(spark, *rows):
    """rows: cycle, kind, second it starts, ms it takes, collected, duplicates, status"""
    return spark.createDataFrame(
        [
            (
                "r",
                n,
                kind,
                START + timedelta(seconds=at),
                START + timedelta(seconds=at, milliseconds=ms),
                START + timedelta(minutes=n),
                got,
                dup,
                1,
                status,
            )
            for n, kind, at, ms, got, dup, status in rows
        ],
        CYCLE,
    )


def test_counters(spark):
    log = log_of(
        spark,
        (0, "initial", 0, 900, 100, 0, "ok"),
        (1, "incremental", 3, 250, 0, 7, "ok"),
        (2, "incremental", 6, 100, 5, 1, "ok"),
        (3, "incremental", 9, 50, 99, 99, "error"),
    )
    (total,) = cycles.metrics_totals(log).collect()
    assert tuple(total) == ("r", 105, 8, 3, 3, 1)
    (average,) = cycles.metrics_avg(log).collect()
    assert average.avg_trades_per_cycle == 35.0
    (errors,) = cycles.error_count(log).collect()
    assert errors.total_errors == 1
    (kept,) = cursor.cursor_totals(log).collect()
    assert tuple(kept) == ("r", 105, 2)  # cycle 1 brought nothing new
    # The failed cycle began after the last completed one had ended.
    now = START + timedelta(seconds=30, microseconds=-1)
    (last,) = cycles.last_cycle(log, now).collect()
    assert (last.last_cycle_duration_ms, last.uptime_seconds) == (6100 - 9000, 29)
    (last,) = cycles.last_cycle(log.filter("status = 'ok'"), now).collect()
    assert last.last_cycle_duration_ms == 100
    (status,) = cursor.collector_status(log, now, "SPECIFIC", ["A"]).collect()
    assert status.configured_tickers == ["A"] and status.total_api_calls == 3
    assert status.last_trade_time == START + timedelta(minutes=2)


def test_counters_without_a_completed_cycle(spark):
    log = log_of(spark, (0, "initial", 0, 10, 5, 0, "error"))
    (average,) = cycles.metrics_avg(log).collect()
    assert average.avg_trades_per_cycle == 0.0
    (last,) = cycles.last_cycle(log, START).collect()
    assert last.last_cycle_duration_ms == 0
    (state,) = cursor.cursor_state(log, START).collect()
    assert not state.initial_load_complete
    assert state.last_trade_time == datetime(2024, 1, 1)


def test_default_cursor_of_an_empty_log(spark):
    empty = spark.createDataFrame([], CYCLE)
    (state,) = cursor.cursor_state(empty, START, by=()).collect()
    assert tuple(state) == (datetime(2024, 1, 1), False, 0, 0, START)


@pytest.mark.parametrize("block", [1, 4, 10_000])
def test_running_counters(spark, block):
    rng = random.Random(block)
    rows = [
        (n, "incremental", n, 1, rng.randrange(9), 0, rng.choice(["ok", "ok", "error"]))
        for n in range(30)
    ]
    found = cycles.metrics_running(log_of(spark, *rows), block).orderBy("cycle").collect()
    trades = done = 0
    for row, (_, _, _, _, got, _, status) in zip(found, rows):
        if status == "ok":
            trades, done = trades + got, done + 1
        assert (row.total_trades_collected, row.total_cycles_completed) == (trades, done)


def test_cursor_advances_without_rows(spark):
    log = log_of(spark, (0, "initial", 0, 900, 100, 0, "ok"))
    state = cursor.cursor_state(log, START)
    now = START + timedelta(minutes=17)
    bounds = state.select(
        "run_id", F.col("last_trade_time").alias("from_ts"), fn.ntz(now).alias("now_ts")
    )
    (moved,) = cursor.cursor_advance(state, cycles.catchup_windows(bounds), now).collect()
    assert (moved.last_trade_time, moved.last_update_time) == (now, now)
    assert moved.total_trades_collected == 100


def test_scalars(spark):
    frame = spark.createDataFrame(
        [(datetime(2024, 1, 15, 10, 30, 45, 999_999),)], "t timestamp_ntz"
    )
    row = frame.select(
        fn.format_time(F.col("t")).alias("text"),
        fn.start_of_day(F.col("t")).alias("day"),
        fn.ingest_millis(datetime(2024, 1, 15, 10, 30, 45, 123_456)).alias("ms"),
        fn.floor_div(F.lit(-7).cast("bigint"), 2).alias("down"),
    ).first()
    assert row.text == "2024-01-15 10:30:45" and row.day == datetime(2024, 1, 15)
    assert (row.ms, row.down) == (1705314645123, -4)
