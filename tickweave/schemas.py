"""Schemas of the records and of the state tables."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(18, 6)
VALUE = T.DecimalType(24, 6)
VOLUME = T.DecimalType(38, 6)

TRADE = T.StructType(
    [
        T.StructField("tradeno", T.LongType(), False),
        T.StructField("tradetime", T.StringType(), False),
        T.StructField("secid", T.StringType(), False),
        T.StructField("boardid", T.StringType(), False),
        T.StructField("price", PRICE, False),
        T.StructField("quantity", T.LongType(), False),
        T.StructField("value", VALUE, False),
        T.StructField("period", T.StringType()),
        T.StructField("tradingsession", T.StringType()),
        T.StructField("buysell", T.StringType()),
        T.StructField("systime", T.StringType()),
        T.StructField("ts_offset", T.LongType()),
        T.StructField("trade_ts", T.TimestampNTZType()),
    ]
)

SECURITY = T.StructType(
    [
        T.StructField("secid", T.StringType(), False),
        T.StructField("boardid", T.StringType(), False),
        T.StructField("shortname", T.StringType()),
        T.StructField("secname", T.StringType()),
        T.StructField("prevprice", PRICE),
        T.StructField("lotsize", T.IntegerType()),
        T.StructField("facevalue", PRICE),
        T.StructField("status", T.StringType()),
        T.StructField("marketprice", PRICE),
        T.StructField("currencyid", T.StringType()),
    ]
)

TRADE_KEY = ["secid", "tradeno"]

# The same key for joins and windows. Spark's sort compares the first column by
# a short prefix, which tells rows apart only if that column has many values.
SORT_KEY = ["tradeno", "secid"]

MESSAGE = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("batch_id", T.LongType()),
        T.StructField("topic", T.StringType()),
    ]
)

SEEN = T.StructType(
    [
        T.StructField("secid", T.StringType()),
        T.StructField("tradeno", T.LongType()),
    ]
)

# The same without a cap: a bitmap for each run of 32,768 numbers.
SEEN_BITS = T.StructType(
    [
        T.StructField("secid", T.StringType()),
        T.StructField("cell", T.LongType()),
        T.StructField("bits", T.BinaryType()),
    ]
)

CURSOR = T.StructType(
    [
        T.StructField("last_trade_time", T.TimestampNTZType()),
        T.StructField("initial_load_complete", T.BooleanType()),
        T.StructField("total_trades_collected", T.LongType()),
        T.StructField("total_cycles_completed", T.LongType()),
        T.StructField("last_update_time", T.TimestampNTZType()),
    ]
)

CYCLE = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("cycle", T.LongType()),
        T.StructField("kind", T.StringType()),  # initial | incremental
        T.StructField("started", T.TimestampNTZType()),
        T.StructField("ended", T.TimestampNTZType()),
        T.StructField("till", T.TimestampNTZType()),  # window end
        T.StructField("collected", T.LongType()),
        T.StructField("duplicates", T.LongType()),
        T.StructField("api_calls", T.LongType()),
        T.StructField("status", T.StringType()),  # ok | error
    ]
)
