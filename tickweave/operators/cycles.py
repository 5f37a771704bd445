"""Catch-up windows, the cycle log, and the counters kept over it."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.functions.scalars import floor_div, micros_between, ntz, whole_second
from tickweave.schemas import TRADE_KEY
from tickweave.settings import CATCH_UP_MINUTES, PAGE_SIZE

SECOND = 1_000_000  # microseconds

# Running totals are carried over blocks of this many consecutive cycles.
CYCLE_BLOCK = 10_000


def _whole_windows(start: Column, now: Column, minutes: int) -> Column:
    """How many full windows come before the last one.

    A cycle covers ``minutes`` only while the gap exceeds that many whole
    minutes, so the last window may be almost one minute longer.
    """
    gap = F.call_function(
        "div", floor_div(micros_between(start, now), SECOND), F.lit(60).cast("bigint")
    )
    over = F.greatest(gap - minutes, F.lit(0).cast("bigint"))
    return F.call_function("div", over + (minutes - 1), F.lit(minutes).cast("bigint"))


def _after(start: Column, windows: Column, minutes: int) -> Column:
    zero = F.lit(0)
    return start + F.make_dt_interval(zero, zero, (windows * minutes).cast("int"), zero)


def catchup_windows(bounds: DataFrame, minutes: int = CATCH_UP_MINUTES) -> DataFrame:
    """The windows each run takes from ``from_ts`` until it reaches ``now_ts``.

    ``bounds`` has one row per run; its other columns are kept. The number of
    windows depends on the gap alone, not on the trades in it.
    """
    keep = [c for c in bounds.columns if c not in ("from_ts", "now_ts")]
    start, now = F.col("from_ts"), F.col("now_ts")
    number = F.col("window_id")
    return (
        bounds.withColumn("_whole", _whole_windows(start, now, minutes))
        .withColumn(
            "window_id", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_whole")))
        )
        .select(
            *keep,
            "window_id",
            _after(start, number, minutes).alias("from_ts"),
            F.when(number == F.col("_whole"), now)
            .otherwise(_after(start, number + 1, minutes))
            .alias("till_ts"),
        )
    )


def whole_windows(start: datetime, now: datetime, minutes: int = CATCH_UP_MINUTES) -> int:
    """The number of full windows for bounds the driver knows."""
    gap = (now - start) // timedelta(minutes=1) if now > start else 0
    return max(0, -((minutes - gap) // minutes))


def next_till(start: datetime, now: datetime, minutes: int = CATCH_UP_MINUTES) -> datetime:
    """Where the next incremental cycle ends."""
    if whole_windows(start, now, minutes):
        return start + timedelta(minutes=minutes)
    return now


def in_windows(trades: DataFrame, start: datetime, last: int, minutes: int) -> DataFrame:
    """Trades since ``start`` with ``window_ids``: the window they fall in, or both of a
    border, earlier first. ``last`` is the number of the last window, which has no end."""
    width = F.lit(minutes * 60 * SECOND).cast("bigint")
    border = F.col("_border")
    on_border = F.col("_on_border") & border.between(1, last)
    number = F.least(border, F.lit(last).cast("bigint"))
    passed = micros_between(ntz(whole_second(start)), F.col("trade_ts"))
    return (
        trades.withColumn("_passed", passed)
        .withColumns(
            {
                "_border": F.call_function("div", F.col("_passed"), width),
                "_on_border": F.pmod("_passed", width) == 0,
            }
        )
        .select(
            *trades.columns,
            F.when(on_border, F.array(border - 1, border))
            .otherwise(F.array(number))
            .alias("window_ids"),
        )
    )


def cycle_log(
    trades: DataFrame,
    seen: DataFrame,
    start: datetime,
    now: datetime,
    minutes: int = CATCH_UP_MINUTES,
    page_size: int = PAGE_SIZE,
) -> DataFrame:
    """What each catch-up cycle from ``start`` to ``now`` fetches and keeps.

    Windows are closed on both sides, so a trade on a border is fetched by two
    of them. A fetched trade is a duplicate when its key was in ``seen`` before
    or was fetched by an earlier window; copies inside one window all count as
    collected. No key leaves the seen-set during the run.

    Rows are counted per key and window before the first shuffle, so a key that
    repeats without end arrives as one row per task. Seen keys join in as rows
    of a window before the first; then the least window of a key says where it
    was collected, without a join.
    """
    first, last = whole_second(start), whole_second(now)
    whole = whole_windows(start, now, minutes)
    inside = trades.filter(F.col("trade_ts").between(ntz(first), ntz(last))).select(*TRADE_KEY, "trade_ts")
    placed = in_windows(inside, start, whole, minutes).select(
        *TRADE_KEY, F.explode("window_ids").alias("window_id")
    )
    per_key = placed.groupBy(*TRADE_KEY, "window_id").agg(F.count(F.lit(1)).alias("n"))
    before = F.lit(-1).cast("bigint")
    known = seen.select(
        *TRADE_KEY, before.alias("window_id"), F.lit(0).cast("bigint").alias("n")
    )
    # The windows of a key, the one that collects it first; each table is read once.
    cells = F.sort_array(F.collect_list(F.struct("window_id", "n"))).alias("cells")
    fetched = (
        per_key.unionByName(known)
        .groupBy(*TRADE_KEY)
        .agg(cells)
        .select(F.col("cells")[0]["window_id"].alias("_first"), F.inline("cells"))
        .filter(F.col("window_id") >= 0)
        .groupBy("window_id")
        .agg(
            F.sum("n").alias("fetched"),
            F.sum(F.when(F.col("window_id") == F.col("_first"), F.col("n"))).alias("collected"),
        )
    )
    windows = trades.sparkSession.range(whole + 1).withColumnRenamed("id", "window_id")
    collected = F.coalesce("collected", F.lit(0).cast("bigint"))
    total = F.coalesce("fetched", F.lit(0).cast("bigint"))
    began = ntz(start)
    return windows.join(fetched, "window_id", "left").select(
        "window_id",
        _after(began, F.col("window_id"), minutes).alias("from_ts"),
        F.when(F.col("window_id") == whole, ntz(now))
        .otherwise(_after(began, F.col("window_id") + 1, minutes))
        .alias("till_ts"),
        collected.alias("collected"),
        (total - collected).alias("duplicates"),
        (F.call_function("div", total, F.lit(page_size).cast("bigint")) + 1).alias(
            "api_calls"
        ),
    )


def _done() -> Column:
    return F.col("status") == "ok"


def _sum(name: str) -> Column:
    return F.coalesce(F.sum(F.when(_done(), F.col(name))), F.lit(0).cast("bigint"))


def total_columns() -> list[Column]:
    """The counters of a run. A failed cycle adds to the errors only."""
    return [
        _sum("collected").alias("total_trades_collected"),
        _sum("duplicates").alias("total_duplicates_filtered"),
        F.count_if(_done()).alias("total_cycles_completed"),
        _sum("api_calls").alias("total_api_calls"),
        F.count_if(~_done()).alias("total_errors"),
    ]


def uptime_seconds(now: datetime) -> Column:
    """A run counts from its first start."""
    up = floor_div(micros_between(F.min("started"), ntz(now)), SECOND)
    return up.alias("uptime_seconds")


def metrics_totals(cycles: DataFrame) -> DataFrame:
    return cycles.groupBy("run_id").agg(*total_columns())


def metrics_running(cycles: DataFrame, block: int = CYCLE_BLOCK) -> DataFrame:
    """Collected trades and completed cycles of each run after every cycle.

    Cycle numbers of a run are consecutive, so a block holds at most ``block``
    rows. Sums of whole blocks are carried forward, and only a block is sorted.
    """
    blocks = cycles.withColumn("_block", floor_div(F.col("cycle"), block))
    done = F.when(_done(), 1).otherwise(0).cast("bigint")
    gained = F.when(_done(), F.col("collected")).otherwise(0)
    earlier = (
        Window.partitionBy("run_id")
        .orderBy("_block")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        blocks.groupBy("run_id", "_block")
        .agg(F.sum(gained).alias("_gained"), F.sum(done).alias("_done"))
        .select(
            "run_id",
            "_block",
            F.coalesce(F.sum("_gained").over(earlier), F.lit(0)).alias("_gained"),
            F.coalesce(F.sum("_done").over(earlier), F.lit(0)).alias("_done"),
        )
    )
    so_far = (
        Window.partitionBy("run_id", "_block")
        .orderBy("cycle")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return blocks.join(carried, ["run_id", "_block"]).select(
        "run_id",
        "cycle",
        (F.col("_gained") + F.sum(gained).over(so_far)).alias("total_trades_collected"),
        (F.col("_done") + F.sum(done).over(so_far)).alias("total_cycles_completed"),
    )


def metrics_avg(cycles: DataFrame) -> DataFrame:
    """Trades per completed cycle, 0.0 when there is none."""
    total, done = F.col("total_trades_collected"), F.col("total_cycles_completed")
    return metrics_totals(cycles).select(
        "run_id",
        F.when(done > 0, total / done).otherwise(0.0).alias("avg_trades_per_cycle"),
    )


def last_cycle(cycles: DataFrame, now: datetime) -> DataFrame:
    """Duration of the latest cycle in milliseconds, and the uptime in seconds.

    The start is that of the latest cycle begun, the end that of the latest
    completed one, so a failed last cycle gives a negative duration.
    """
    ended = F.max(F.when(_done(), F.col("ended")))
    took = floor_div(micros_between(F.max("started"), ended), 1000)
    return cycles.groupBy("run_id").agg(
        F.coalesce(took, F.lit(0).cast("bigint")).alias("last_cycle_duration_ms"),
        uptime_seconds(now),
    )


def error_count(cycles: DataFrame) -> DataFrame:
    return cycles.groupBy("run_id").agg(F.count_if(~_done()).alias("total_errors"))
