"""Newest-N, pages, and the page each trade falls in.

All orders are total: time, trade number, instrument, then every other column,
so rows that still tie are copies of each other.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.functions.scalars import floor_div, micros_between, ntz
from tickweave.operators.selection import (
    filter_symbol,
    filter_symbol_time_range,
    filter_time_range,
)
from tickweave.settings import LATEST_LIMIT, PAGE_SIZE
from tickweave.storage import stage

# Up to this many leading rows a page is a plain top-k. Every task keeps that
# many and one task merges them, so the number must be small where tasks are
# many. Longer pages are located by counts first.
TOP_K_ROWS = 200

# Among at most this many rows, a top-k of any length is fine: one task merges
# them, and rows of trades are a few hundred bytes wide.
SORT_ROWS = 200_000

# Widths of the time slots that locate a page, in microseconds.
EPOCH = datetime(1970, 1, 1)
SLOTS = (3_600_000_000, 1_000_000, 1)


def total_order(names: list[str], reverse: bool = False) -> list[Column]:
    lead = ["trade_ts", "tradeno"]
    rest = sorted(c for c in names if c not in lead and c != "secid")
    ties = ["secid", *rest] if "secid" in names else rest
    if reverse:
        newest = [F.col(c).desc_nulls_last() for c in lead]
    else:
        newest = [F.col(c).asc_nulls_last() for c in lead]
    return [*newest, *(F.col(c).asc_nulls_last() for c in ties)]


def latest_trades(trades: DataFrame, limit: int = LATEST_LIMIT) -> DataFrame:
    """The newest trades over all instruments."""
    return trades_page(trades, limit)


def latest_trades_symbol(
    trades: DataFrame, symbol: str, limit: int = LATEST_LIMIT
) -> DataFrame:
    return trades_page(filter_symbol(trades, symbol), limit)


def trades_page(
    trades: DataFrame,
    limit: int = PAGE_SIZE,
    start: int = 0,
    reverse: bool = True,
    top_k_rows: int = TOP_K_ROWS,
    sort_rows: int = SORT_ROWS,
) -> DataFrame:
    """One page of all trades, newest first unless ``reverse`` is off.

    A page beyond the first rows is located by time: counts per hour tell which
    hours it touches, and only those are read again, which the scan can tell
    from its statistics. Busy hours are narrowed down to seconds and then to
    single moments. Where one moment holds more rows than should be sorted in
    one place, its rows get positions. The page comes in order in any case.
    """
    order = total_order(trades.columns, reverse)
    if start + limit <= top_k_rows:
        return trades.orderBy(*order).offset(start).limit(limit)
    near, ahead = trades, start
    for width in SLOTS:
        near, ahead, rows = _narrow(near, limit, ahead, reverse, width)
        if rows <= sort_rows:
            return near.orderBy(*order).offset(ahead).limit(limit)
    placed = with_positions(near, order)
    inside = (F.col("position") >= ahead) & (F.col("position") < ahead + limit)
    return placed.filter(inside).orderBy("position").select(*trades.columns)


def trades_range_page(
    trades: DataFrame,
    start_ts: datetime | str,
    till_ts: datetime | str,
    limit: int = PAGE_SIZE,
    start: int = 0,
    reverse: bool = False,
    symbol: str | None = None,
) -> DataFrame:
    """One page of a time range, oldest first unless ``reverse`` is on."""
    if symbol is None:
        inside = filter_time_range(trades, start_ts, till_ts)
    else:
        inside = filter_symbol_time_range(trades, symbol, start_ts, till_ts)
    return trades_page(inside, limit, start, reverse)


def _moment(micros: int) -> datetime | None:
    """A moment by its microseconds; None outside the years 1 to 9999, which as a
    bound holds for all trades."""
    try:
        return EPOCH + timedelta(microseconds=micros)
    except OverflowError:
        return None


def located(slots: DataFrame, limit: int, start: int, reverse: bool) -> Row:
    """Which slots a page touches, from (slot, n) with one row per slot: the ``first`` and
    ``last`` of them, whether ``timeless`` rows are among them, how many rows stand
    ``ahead`` of these slots, and how many ``rows`` they hold, NULL if none is touched.

    One row per slot is ordered, and a single row comes back to the driver.
    """
    along = F.col("slot").desc_nulls_last() if reverse else F.col("slot").asc_nulls_last()
    running = Window.orderBy(along).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return (
        slots.withColumn("after", F.sum("n").over(running))
        .withColumn("before", F.col("after") - F.col("n"))
        .filter((F.col("after") > start) & (F.col("before") < start + limit))
        .agg(
            F.min("slot").alias("first"),
            F.max("slot").alias("last"),
            F.count_if(F.col("slot").isNull()).alias("timeless"),
            F.min("before").alias("ahead"),
            F.sum("n").alias("rows"),
        )
        .first()
    )


def _narrow(
    trades: DataFrame, limit: int, start: int, reverse: bool, width: int
) -> tuple[DataFrame, int, int]:
    """The trades of the time slots a page touches, how many of them stand
    ahead of the page, and how many there are. Only times are read for the counts.
    """
    slot = floor_div(micros_between(ntz(EPOCH), F.col("trade_ts")), width)
    slots = trades.groupBy(slot.alias("slot")).agg(F.count(F.lit(1)).alias("n"))
    touched = located(slots, limit, start, reverse)
    if touched["rows"] is None:
        return trades.limit(0), 0, 0
    return trades.filter(inside_slots(touched, width)), start - touched["ahead"], touched["rows"]


def inside_slots(touched: Row, width: int) -> Column:
    """Whether a trade lies in the slots that were located."""
    inside = F.lit(False)
    if touched["first"] is not None:
        first, after = _moment(touched["first"] * width), _moment((touched["last"] + 1) * width)
        inside = F.col("trade_ts").isNotNull()
        if first is not None:
            inside = inside & (F.col("trade_ts") >= ntz(first))
        if after is not None:
            inside = inside & (F.col("trade_ts") < ntz(after))
    if touched["timeless"]:
        inside = inside | F.col("trade_ts").isNull()
    return inside


def with_positions(
    df: DataFrame, order: list[Column], group: tuple[str, ...] = ()
) -> DataFrame:
    """The rows with the 0-based ``position`` of each within its group under ``order``.

    Unlike ``row_number() over (partition by group)`` no group is sorted in one
    task, however large it is, nor are the copies of one row: rows are
    range-partitioned by group and order, and by a number of their own where these
    tie, which cuts large groups and many copies into pieces. Each piece is written
    down in order, numbered; the position is that number, moved by the rows of the
    group in the pieces before, from a table of one row per group and piece. So the
    rows are shuffled once.

    The columns of ``group`` must not hold NULL.
    """
    along = [*(F.col(c).asc_nulls_last() for c in group), *order]
    dealt = df.withColumn("_tie", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange(*along, F.col("_tie")).sortWithinPartitions(*along)
    numbered = stage(
        dealt.select(*df.columns, F.monotonically_increasing_id().alias("_number")),
        "positions",
    ).withColumn("_piece", F.shiftright("_number", 33))
    pieces = numbered.groupBy(*group, "_piece").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_number").alias("_first")
    )
    earlier = (
        Window.partitionBy(*group)
        .orderBy("_piece")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0))
    moves = pieces.select(*group, "_piece", (before - F.col("_first")).alias("_move"))
    return numbered.join(moves, [*group, "_piece"]).select(
        *df.columns, (F.col("_number") + F.col("_move")).alias("position")
    )


def page_assignment(
    trades: DataFrame, size: int = PAGE_SIZE, per_symbol: bool = True
) -> DataFrame:
    """The page each trade is delivered in when its instrument is drained.

    Only the ordering columns are moved. ``per_symbol=False`` pages all
    instruments together.
    """
    group = ("secid",) if per_symbol else ()
    # A missing instrument is "" in the data model.
    secid = F.coalesce("secid", F.lit("")).alias("secid")
    keys = trades.select(secid, "trade_ts", "tradeno")
    order = total_order([c for c in keys.columns if c not in group])
    return with_positions(keys, order, group).select(
        *keys.columns,
        F.call_function("div", F.col("position"), F.lit(size)).alias("page"),
    )


def page_count(
    trades: DataFrame, size: int = PAGE_SIZE, per_symbol: bool = True
) -> DataFrame:
    """Requests needed to drain the trades: ``n div size + 1``."""
    group = ["secid"] if per_symbol else []
    pages = F.call_function("div", F.count(F.lit(1)), F.lit(size)) + 1
    return trades.groupBy(*group).agg(
        F.count(F.lit(1)).alias("trades"), pages.alias("pages")
    )
