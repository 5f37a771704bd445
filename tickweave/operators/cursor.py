"""The resume cursor: how far a run got, and its running totals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions.scalars import ntz, start_of_day
from tickweave.operators.cycles import total_columns, uptime_seconds


def _done() -> Column:
    return F.col("status") == "ok"


def _counted() -> Column:
    """Cycles that reach the cursor's totals: initial ones, and incremental
    ones that brought something new."""
    return _done() & ((F.col("kind") == "initial") | (F.col("collected") > 0))


def _latest(name: str) -> Column:
    return F.max_by(F.when(_done(), F.col(name)), F.when(_done(), F.col("cycle")))


def _total() -> Column:
    return F.coalesce(
        F.sum(F.when(_counted(), F.col("collected"))), F.lit(0).cast("bigint")
    )


def default_cursor(now: datetime) -> dict[str, Column]:
    """The cursor of a run that has none: midnight, nothing loaded."""
    moment = ntz(now)
    return {
        "last_trade_time": start_of_day(moment),
        "initial_load_complete": F.lit(False),
        "total_trades_collected": F.lit(0).cast("bigint"),
        "total_cycles_completed": F.lit(0).cast("bigint"),
        "last_update_time": moment,
    }


def cursor_columns(now: datetime) -> list[Column]:
    """The fold of a cycle log to a cursor; what the log lacks is defaulted."""
    folded = {
        "last_trade_time": _latest("till"),
        "initial_load_complete": F.bool_or(_done() & (F.col("kind") == "initial")),
        "total_trades_collected": _total(),
        "total_cycles_completed": F.count_if(_counted()),
        "last_update_time": _latest("ended"),
    }
    default = default_cursor(now)
    return [F.coalesce(v, default[name]).alias(name) for name, v in folded.items()]


def cursor_state(
    cycles: DataFrame, now: datetime, by: Sequence[str] = ("run_id",)
) -> DataFrame:
    """The cursor each run has after its logged cycles.

    With ``by=()`` the log is one run and gives one row, the default cursor if
    the log is empty.
    """
    return cycles.groupBy(*by).agg(*cursor_columns(now))


def cursor_advance(cursor: DataFrame, windows: DataFrame, now: datetime) -> DataFrame:
    """Each run's cursor moved to the end of its last window, rows or no rows."""
    reached = windows.groupBy("run_id").agg(
        F.max_by("till_ts", "window_id").alias("_till")
    )
    moved = F.col("_till").isNotNull()
    return cursor.join(reached, "run_id", "left").select(
        "run_id",
        F.coalesce("_till", "last_trade_time").alias("last_trade_time"),
        "initial_load_complete",
        "total_trades_collected",
        "total_cycles_completed",
        F.when(moved, ntz(now)).otherwise(F.col("last_update_time")).alias(
            "last_update_time"
        ),
    )


def cursor_totals(cycles: DataFrame) -> DataFrame:
    """The totals kept in the cursor; cycles without new rows are left out."""
    return cycles.groupBy("run_id").agg(
        _total().alias("total_trades_collected"),
        F.count_if(_counted()).alias("total_cycles_completed"),
    )


def collector_status(
    cycles: DataFrame,
    now: datetime,
    mode: str,
    symbols: Sequence[str],
    enabled: bool = True,
) -> DataFrame:
    """One row per run: settings, cursor and counters, from one pass of the log."""
    cursor = cursor_columns(now)[:2]
    return (
        cycles.groupBy("run_id")
        .agg(*cursor, *total_columns(), uptime_seconds(now))
        .select(
            "run_id",
            F.lit(enabled).alias("enabled"),
            F.lit(mode).alias("mode"),
            F.array(*(F.lit(s) for s in symbols)).cast("array<string>").alias(
                "configured_tickers"
            ),
            "initial_load_complete",
            "last_trade_time",
            "total_trades_collected",
            "total_cycles_completed",
            "total_api_calls",
            "total_errors",
            "uptime_seconds",
        )
    )
