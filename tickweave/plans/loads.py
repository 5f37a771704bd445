"""The two load modes as plans, and one collection cycle as a job."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import suppress
from dataclasses import dataclass, replace
from datetime import datetime, timedelta

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.operators.cycles import in_windows, next_till, whole_windows
from tickweave.operators.dedup import dedup_trades, filter_new_trades, mark_batch
from tickweave.operators.selection import (
    distinct_securities,
    filter_symbols,
    filter_time_range,
)
from tickweave.plans.archive import TradeArchive, refuse
from tickweave.plans.state import CollectorState
from tickweave.settings import FAIL, Settings
from tickweave.sinks.messages import FileSink, KafkaSink, sink_securities, sink_trades
from tickweave.sources.envelope import sound


def initial_load(
    trades: DataFrame,
    start: datetime,
    till: datetime,
    symbols: Sequence[str] | None = None,
    dedupe: bool = False,
) -> DataFrame:
    """The whole range from the cursor to now, not checked against the seen-set.

    As it stands it is a filter, which moves no row between tasks.
    """
    wanted = filter_time_range(filter_symbols(trades, symbols), start, till)
    return dedup_trades(wanted) if dedupe else wanted


def incremental_load(
    trades: DataFrame,
    seen: DataFrame,
    start: datetime,
    till: datetime,
    symbols: Sequence[str] | None = None,
    dedupe: bool = True,
) -> DataFrame:
    """The range since the cursor without the trades seen before.

    Copies go first: that leaves one row per key, placed by key, so the
    anti-join adds no shuffle of the trades and meets no hot key.
    """
    return filter_new_trades(initial_load(trades, start, till, symbols, dedupe), seen)


def commit_cycle(
    state: CollectorState,
    sink: FileSink | KafkaSink,
    count_fetched: Callable[[], int],
    fresh: DataFrame,
    cycle: dict,
    settings: Settings,
    clock: Callable[[], datetime],
) -> dict:
    """Write what one cycle found, then move the state on.

    ``fresh`` is computed once, into the table of accepted trades; messages,
    seen-set and counts are read from there, messages and seen-set at the same
    time; of the seen-set only the buckets of accepted trades are read and
    written. Every step replaces its own output, and the cursor comes last, so a
    cycle that breaks off is simply done again.
    """
    spark = fresh.sparkSession
    version = cycle["cycle"]
    # Side threads work under the job group and the properties of this one.
    here = inheritable_thread_target(spark)
    sink = replace(sink, generation=state.generation or sink.generation)
    with ThreadPoolExecutor(2) as side:
        counted = side.submit(here(count_fetched))
        accepted = state.write_accepted(fresh, version)
        sent = side.submit(here(sink_trades), accepted, sink, cycle["started"], version)
        buckets = state.buckets(accepted)
        held = state.read_seen(spark, version - 1, buckets, settings.seen_cap is None)
        marked = mark_batch(held, accepted, settings.seen_cap)
        kept = side.submit(here(state.write_seen), marked, version, buckets)
        collected = accepted.count()
        for step in (sent, kept):
            step.result()
        fetched = counted.result()
    row = {
        **cycle,
        "run_id": settings.run_id,
        "ended": clock(),
        "collected": collected,
        "duplicates": fetched - collected,
        "api_calls": fetched // settings.page_size + 1,
        "status": "ok",
    }
    state.write_cycle(spark, row)
    return row


def set_faults_aside(
    state: CollectorState, decoded: DataFrame, version: int, settings: Settings
) -> DataFrame:
    """The sound trades among rows of ``decode_all_trades``.

    What could not be read fails the cycle, which then commits nothing; or it goes
    to the quarantine of the state, if the settings say so.
    """
    if "fault" not in decoded.columns:
        return decoded
    faults = decoded.filter(F.col("fault").isNotNull()).select("file", "fault", "sent")
    if settings.on_fault == FAIL:
        refuse(faults)
    elif not faults.isEmpty():
        state.write_quarantine(faults, version)
    return sound(decoded)


@dataclass(frozen=True)
class Landed:
    """What a cycle fetches from: landed responses, of which those that are new go to an
    archive first, and the window is read from there."""

    spark: SparkSession
    archive: TradeArchive
    stream: Callable[[], DataFrame]  # rows of ``decode_all_trades``, as a stream

    def window(
        self, state: CollectorState, version: int, start: datetime, till: datetime, settings: Settings
    ) -> DataFrame:
        taken = self.archive.absorb(self.stream(), settings)
        faults = self.archive.faults(self.spark, taken).drop("batch")
        if taken and not faults.isEmpty():
            state.write_quarantine(faults, version)
        return self.archive.window(self.spark, start, till)


def failed(state: CollectorState, spark: SparkSession, cycle: dict) -> None:
    """Log a failed cycle. Called while its error is on its way, which must not be
    hidden by the log's own."""
    with suppress(Exception):
        state.log_error(spark, cycle)


def run_cycle(
    trades: DataFrame | Landed,
    state: CollectorState,
    sink: FileSink | KafkaSink,
    settings: Settings,
    clock: Callable[[], datetime] = datetime.now,
    dedupe: bool = True,
    most_windows: int = 1,
) -> dict | None:
    """One tick of the collector over a table of trades, or over landed responses.

    After a gap a tick may take up to ``most_windows`` windows as one job, which sends
    and logs what as many ticks would; with ``dedupe=False`` it takes one.

    Of landed responses only new ones are decoded, and only the hours of the window are
    read; of the seen-set only the buckets of the instruments that traded in it. So what
    a tick reads does not grow with the history.

    Returns the last row it added to the cycle log, or None when it is switched
    off. A failure is logged and raised; the cursor stays where it was, and the
    next tick does the same window again.
    """
    if not settings.enabled:
        return None
    spark = trades.spark if isinstance(trades, Landed) else trades.sparkSession
    started = clock()
    cursor = state.read_cursor(spark, started)
    initial = not cursor["initial_load_complete"]
    till, windows = started, 1
    if not initial:
        start, minutes = cursor["last_trade_time"], settings.catch_up_minutes
        till = next_till(start, started, minutes)
        behind = min(whole_windows(start, started, minutes), most_windows if dedupe else 1)
        if behind > 1 and (windows := state.most_windows(cursor["version"] + 1, behind)) > 1:
            till = start + timedelta(minutes=windows * minutes)
    own, plan = state.begin(
        spark,
        cursor["version"] + 1,
        "initial" if initial else "incremental",
        cursor["last_trade_time"],
        till,
        windows,
        settings.catch_up_minutes,
    )
    start, till = plan["start"], plan["till"]
    cycle = {
        "cycle": plan["version"],
        "kind": plan["kind"],
        "started": started,
        "till": till,
    }
    try:
        symbols = settings.selection()
        if isinstance(trades, Landed):
            fetched = trades.window(own, plan["version"], start, till, settings)
        else:
            fetched = set_faults_aside(own, trades, plan["version"], settings)
        wanted = filter_time_range(filter_symbols(fetched, symbols), start, till)
        fresh = dedup_trades(wanted) if dedupe else wanted
        if not initial:
            bits = settings.seen_cap is None
            seen = own.read_seen(spark, cursor["version"], own.buckets(wanted), bits)
            fresh = filter_new_trades(fresh, seen)
        if (plan["windows"] or 1) > 1:
            rows = _commit_windows(own, sink, wanted, fresh, cycle, plan, settings, clock)
        else:
            rows = [commit_cycle(own, sink, wanted.count, fresh, cycle, settings, clock)]
    except Exception:
        failed(own, spark, {**cycle, "run_id": settings.run_id, "ended": clock()})
        raise
    own.write_cursor(
        spark,
        {
            "version": rows[-1]["cycle"],
            "last_trade_time": till,
            "initial_load_complete": True,
            "total_trades_collected": cursor["total_trades_collected"] + sum(r["collected"] for r in rows),
            "total_cycles_completed": cursor["total_cycles_completed"]
            + sum(initial or r["collected"] > 0 for r in rows),
            "last_update_time": rows[-1]["ended"],
        },
    )
    return rows[-1]


def _commit_windows(
    state: CollectorState,
    sink: FileSink | KafkaSink,
    wanted: DataFrame,
    fresh: DataFrame,
    cycle: dict,
    plan: dict,
    settings: Settings,
    clock: Callable[[], datetime],
) -> list[dict]:
    """Several windows as one job and one commit: the rows they add to the cycle log.

    ``fresh`` holds one row per new key, its earliest; the earliest window it lies in
    collects it, as it would if the windows came one by one. Every window has its own
    messages and its own row in the log. The seen-set takes the numbers of all windows at
    once, so a number pushed out by the cap between two of them is not sent again.
    """
    spark, first, n = fresh.sparkSession, plan["version"], plan["windows"]
    version = first + n - 1
    sink = replace(sink, generation=state.generation or sink.generation)
    here = inheritable_thread_target(spark)

    def per_window(trades: DataFrame, ids: Column) -> dict[int, int]:
        counted = trades.select(F.explode(ids).alias("w")).groupBy("w").agg(F.count(F.lit(1)).alias("n"))
        return {row.w: row.n for row in counted.collect()}  # as many as windows

    with ThreadPoolExecutor(2) as side:
        placed = in_windows(wanted.select("trade_ts"), plan["start"], n - 1, plan["minutes"])
        counted = side.submit(here(per_window), placed, F.col("window_ids"))
        placed = in_windows(fresh, plan["start"], n - 1, plan["minutes"])
        accepted = state.write_accepted(placed, version)
        number = F.col("window_ids")[0]
        sent = side.submit(here(sink_trades), accepted, sink, cycle["started"], number + first)
        buckets = state.buckets(accepted)
        held = state.read_seen(spark, first - 1, buckets, settings.seen_cap is None)
        marked = mark_batch(held, accepted, settings.seen_cap)
        kept = side.submit(here(state.write_seen), marked, version, buckets, first - 1)
        collected = per_window(accepted, F.array(number))
        for step in (sent, kept):
            step.result()
        fetched = counted.result()
    ended = clock()
    rows = [
        {
            **cycle,
            "cycle": first + i,
            "till": plan["start"] + timedelta(minutes=(i + 1) * plan["minutes"]),
            "run_id": settings.run_id,
            "ended": ended,
            "collected": collected.get(i, 0),
            "duplicates": fetched.get(i, 0) - collected.get(i, 0),
            "api_calls": fetched.get(i, 0) // settings.page_size + 1,
            "status": "ok",
        }
        for i in range(n)
    ]
    state.write_cycle(spark, *rows)
    return rows


def load_instruments(securities: DataFrame, sink: FileSink | KafkaSink) -> DataFrame:
    """Send every instrument, and return the set of their ids."""
    sink_securities(securities, sink)
    return distinct_securities(securities)
