"""Which trades: by instrument, by time range, or both."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickweave.functions.scalars import ntz, whole_second
from tickweave.storage import stage

# So many symbols, and so many bytes of them, fit well into every executor.
BROADCAST_SYMBOLS = 200_000
BROADCAST_BYTES = 8 << 20


def filter_symbol(trades: DataFrame, symbol: str) -> DataFrame:
    return trades.filter(F.col("secid") == symbol)


def filter_symbols(
    trades: DataFrame, symbols: Sequence[str] | DataFrame | None
) -> DataFrame:
    """Trades of the listed instruments; ``None`` keeps them all.

    A short list becomes an IN filter that reaches the scan. A table of symbols
    is written down and measured first: up to a limit it is broadcast, so the
    trades of a busy instrument stay where they are. Beyond it, it is a
    shuffled semi-join whose hot keys adaptive execution splits. A symbol
    listed twice counts once.
    """
    if symbols is None:
        return trades
    if isinstance(symbols, DataFrame):
        wanted = stage(symbols.select("secid").distinct(), "symbols")
        size = wanted.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length("secid")).alias("bytes")).first()
        if size["n"] <= BROADCAST_SYMBOLS and (size["bytes"] or 0) <= BROADCAST_BYTES:
            wanted = F.broadcast(wanted)
        return trades.join(wanted, "secid", "left_semi")
    return trades.filter(F.col("secid").isin(sorted(set(symbols))))


def filter_time_range(
    trades: DataFrame, start: datetime | str, till: datetime | str
) -> DataFrame:
    """Trades with ``start <= trade_ts <= till``, bounds cut to whole seconds."""
    return trades.filter(
        F.col("trade_ts").between(ntz(whole_second(start)), ntz(whole_second(till)))
    )


def filter_symbol_time_range(
    trades: DataFrame, symbol: str, start: datetime | str, till: datetime | str
) -> DataFrame:
    return filter_time_range(filter_symbol(trades, symbol), start, till)


def drain_range(
    trades: DataFrame, start: datetime | str, till: datetime | str
) -> DataFrame:
    """Every page of a range, which is the range itself.

    Spark's scan tasks take the place of the page loop, so no page ever waits
    for the one before it.
    """
    return filter_time_range(trades, start, till)


def drain_range_symbol(
    trades: DataFrame, symbol: str, start: datetime | str, till: datetime | str
) -> DataFrame:
    return filter_symbol_time_range(trades, symbol, start, till)


def union_symbols(trades: DataFrame, symbols: Sequence[str]) -> DataFrame:
    """The results of one request per instrument, put together.

    Stated as one filter, so the table is scanned once and not once per symbol.
    """
    return filter_symbols(trades, symbols)


def distinct_securities(records: DataFrame) -> DataFrame:
    return records.select("secid").distinct()
