"""Column expressions on trades, instruments and times. All stay in the JVM."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

def ntz(value: datetime | str | Column) -> Column:
    """A zone-less timestamp literal.

    Written as a cast text so that it folds to a TIMESTAMP_NTZ literal, and a
    comparison with a TIMESTAMP_NTZ column still reaches the Parquet scan.
    """
    if isinstance(value, Column):
        return value.cast("timestamp_ntz")
    return F.lit(str(value)).cast("timestamp_ntz")


def whole_second(value: datetime | str) -> datetime:
    """A range bound as the service reads it: the fraction is cut."""
    moment = datetime.fromisoformat(value) if isinstance(value, str) else value
    return moment.replace(microsecond=0)


def micros_between(start: Column, end: Column) -> Column:
    """Microseconds from ``start`` to ``end``, both zone-less.

    The parts of the interval are added up, as a detour over TIMESTAMP would
    depend on the daylight saving rules of the session zone.
    """
    gap = end - start
    seconds = (
        F.extract(F.lit("DAY"), gap).cast("bigint") * 86400
        + F.extract(F.lit("HOUR"), gap).cast("bigint") * 3600
        + F.extract(F.lit("MINUTE"), gap).cast("bigint") * 60
    )
    fraction = (F.extract(F.lit("SECOND"), gap) * 1_000_000).cast("bigint")
    return seconds * 1_000_000 + fraction


def floor_div(number: Column, by: int) -> Column:
    """Integer division that rounds toward minus infinity, in 64 bits."""
    step = F.lit(by).cast("bigint")
    return F.call_function("div", number - F.pmod(number, step), step)


def total_volume(price: str = "price", quantity: str = "quantity") -> Column:
    """price x quantity, exact: (18,6) x (19,0) fits (38,6) without rounding."""
    return F.col(price).cast("decimal(18,6)") * F.col(quantity).cast("decimal(19,0)")


def ingest_millis(ingest_ts: datetime | None = None) -> Column:
    """Wall-clock milliseconds put on each record, one value per batch."""
    if ingest_ts is None:
        return F.unix_millis(F.current_timestamp())
    since_epoch = ingest_ts - datetime(1970, 1, 1)
    return F.lit(since_epoch // timedelta(milliseconds=1)).cast("bigint")


def message_key(secid: str = "secid", tradeno: str = "tradeno") -> Column:
    return F.concat_ws(":", F.col(secid), F.col(tradeno).cast("string"))


def format_time(moment: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss``; the fraction is cut, not rounded.

    Taken from the text of the time, as ``date_format`` would read a zone-less
    time in the session zone, where an hour may be missing.
    """
    return F.substring(moment.cast("string"), 1, 19)


def start_of_day(moment: Column) -> Column:
    return moment.cast("date").cast("timestamp_ntz")


def trade_json(ingest_ts: datetime | None = None) -> Column:
    """A trade as the message value: 12 stored and 2 derived fields, nulls kept."""
    stored = [
        "tradeno",
        "tradetime",
        "secid",
        "boardid",
        "price",
        "quantity",
        "value",
        "period",
        "tradingsession",
        "buysell",
        "systime",
        "ts_offset",
    ]
    record = F.struct(
        *stored,
        total_volume().alias("totalVolume"),
        ingest_millis(ingest_ts).alias("timestamp"),
    )
    return F.to_json(record, {"ignoreNullFields": "false"})


def security_json() -> Column:
    """An instrument as the message value, nulls kept."""
    record = F.struct(
        "secid",
        "boardid",
        "shortname",
        "secname",
        "prevprice",
        "lotsize",
        "facevalue",
        "status",
        "marketprice",
        "currencyid",
    )
    return F.to_json(record, {"ignoreNullFields": "false"})
