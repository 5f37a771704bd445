"""The given tables seen as trades, instruments, responses and cycle logs."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tickweave.functions.scalars import floor_div, format_time, ntz, start_of_day
from tickweave.schemas import PRICE, TRADE, VALUE
from tickweave.settings import PAGE_SIZE

# When the collector of the example restarts: trades up to here were seen.
RESTART = datetime(2024, 1, 12, 6, 0, 0)
EPOCH_DAY = "2024-01-01"
FILE_ROWS = 500_000  # of a landed file, on average


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stream_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table as a file stream, whether it is one file or a folder of files."""
    batch = table(spark, sf_dir, name)
    reader = spark.readStream.schema(batch.schema)
    if any(f.rstrip("/").endswith(f"/{name}.parquet") for f in batch.inputFiles()[:1]):
        return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)
    return reader.parquet(f"{sf_dir}/{name}.parquet")


def event_trades(events: DataFrame) -> DataFrame:
    """``events`` as trades with unique keys."""
    price = F.col("value").cast(PRICE)
    quantity = F.get_json_object("props", "$.k").cast("bigint")
    side = F.when(F.col("event_id") % 2 == 0, "B").otherwise("S")
    return events.select(
        F.col("event_id").alias("tradeno"),
        format_time(F.col("ts")).alias("tradetime"),
        F.col("event_type").alias("secid"),
        F.concat(F.lit("B"), (F.col("user_id") % 3).cast("string")).alias("boardid"),
        price.alias("price"),
        quantity.alias("quantity"),
        (price * quantity.cast("decimal(10,0)")).cast(VALUE).alias("value"),
        F.lit(None).cast("string").alias("period"),
        F.lit(None).cast("string").alias("tradingsession"),
        side.alias("buysell"),
        F.lit(None).cast("string").alias("systime"),
        F.lit(None).cast("bigint").alias("ts_offset"),
        F.col("ts").alias("trade_ts"),
    )


def lineitem_trades(lineitem: DataFrame) -> DataFrame:
    """``lineitem`` as trades: keys repeat, and times are whole days.

    The price is rounded half up in so many words, as engines differ in how a
    cast treats ties.
    """
    quantity = F.col("l_quantity").cast("bigint")
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return lineitem.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("tradeno"),
        format_time(F.col("l_shipdate")).alias("tradetime"),
        F.col("l_returnflag").alias("secid"),
        F.col("l_linestatus").alias("boardid"),
        (F.floor(unit * 1_000_000 + 0.5) / 1_000_000).cast(PRICE).alias("price"),
        quantity.alias("quantity"),
        F.col("l_extendedprice").cast(VALUE).alias("value"),
        F.col("l_shipdate").alias("trade_ts"),
    )


def full_trades(trades: DataFrame) -> DataFrame:
    """Trades with every column of the data model, those they lack being NULL."""
    lacking = [f for f in TRADE.fields if f.name not in trades.columns]
    empty = {f.name: F.lit(None).cast(f.dataType) for f in lacking}
    return trades.withColumns(empty).select(*TRADE.fieldNames())


def part_securities(part: DataFrame) -> DataFrame:
    return part.select(
        F.concat(F.lit("P"), F.col("p_partkey").cast("string")).alias("secid"),
        F.col("p_brand").alias("boardid"),
        F.col("p_name").alias("shortname"),
        F.col("p_type").alias("secname"),
        F.col("p_retailprice").cast(PRICE).alias("prevprice"),
        F.col("p_size").cast("int").alias("lotsize"),
        F.lit(None).cast(PRICE).alias("facevalue"),
        F.lit(None).cast("string").alias("status"),
        F.lit(None).cast(PRICE).alias("marketprice"),
        F.lit(None).cast("string").alias("currencyid"),
    )


def seen_before(trades: DataFrame, restart: datetime = RESTART) -> DataFrame:
    """Keys collected before the restart."""
    return trades.filter(F.col("trade_ts") <= ntz(restart)).select("secid", "tradeno")


def daily_cycles(trades: DataFrame, page_size: int = PAGE_SIZE) -> DataFrame:
    """A cycle log: one run per board, one cycle per day.

    Trades up to the restart count as duplicates; a day that closes with an
    ``error`` trade counts as failed.
    """
    day = start_of_day(F.col("trade_ts"))
    known = F.count_if(F.col("trade_ts") <= ntz(RESTART))
    n = F.count(F.lit(1))
    return (
        trades.groupBy(F.col("boardid").alias("run_id"), day.alias("day"))
        .agg(
            F.min("trade_ts").alias("started"),
            F.max("trade_ts").alias("ended"),
            (n - known).alias("collected"),
            known.alias("duplicates"),
            (F.call_function("div", n, F.lit(page_size).cast("bigint")) + 1).alias(
                "api_calls"
            ),
            F.max_by(F.col("secid") == "error", "tradeno").alias("failed"),
        )
        .select(
            "run_id",
            F.datediff("day", F.lit(EPOCH_DAY)).cast("bigint").alias("cycle"),
            F.when(F.col("day") == ntz(EPOCH_DAY), "initial")
            .otherwise("incremental")
            .alias("kind"),
            "started",
            "ended",
            (F.col("day") + F.expr("interval 1 day")).alias("till"),
            "collected",
            "duplicates",
            "api_calls",
            F.when(F.col("failed"), "error").otherwise("ok").alias("status"),
        )
    )


def _blocks(cells: DataFrame, block: str, names: list[str], rows: int) -> DataFrame:
    """Rows of cells packed into responses of at most ``rows`` rows each.

    The row number inside a scan task picks the response, so none grows with
    the data.
    """
    header = F.array(*(F.lit(name) for name in names))
    return (
        cells.withColumn(
            "_block",
            F.call_function("div", F.monotonically_increasing_id(), F.lit(rows)),
        )
        .groupBy("_block")
        .agg(F.collect_list("cells").alias("_rows"))
        .select(
            F.to_json(
                F.struct(
                    F.struct(header.alias("columns"), F.col("_rows").alias("data")).alias(
                        block
                    ),
                    F.struct(F.array().alias("columns")).alias("marketdata"),
                )
            ).alias("value")
        )
    )


def trade_responses(trades: DataFrame, rows: int = PAGE_SIZE) -> DataFrame:
    """Trades as response texts, one per row."""
    names = ["BUYSELL", "TRADENO", "TRADETIME", "SECID", "BOARDID"]
    numbers = ["PRICE", "QUANTITY", "VALUE"]
    cells = F.array(*(F.col(n.lower()).cast("variant") for n in names + numbers))
    return _blocks(trades.select(cells.alias("cells")), "trades", names + numbers, rows)


def broken_responses(trades: DataFrame, rows: int = PAGE_SIZE) -> DataFrame:
    """Responses with the faults the decoder must bear, one kind per instrument:
    a null row, a number sent as text, a short row, and null cells."""
    names = ["TRADENO", "TRADETIME", "SECID", "BOARDID", "PRICE", "QUANTITY", "VALUE"]
    whole = {n: F.col(n.lower()).cast("variant") for n in names}
    as_text = {**whole, "PRICE": F.col("price").cast("string").cast("variant")}
    nothing = F.lit(None).cast("variant")
    empty = {**whole, "BOARDID": nothing, "QUANTITY": nothing}
    cells = (
        F.when(F.col("secid") == "view", F.array(*as_text.values()))
        .when(F.col("secid") == "click", F.array(*list(whole.values())[:5]))
        .when(F.col("secid") == "signup", F.array(*empty.values()))
        .when(F.col("secid") != "error", F.array(*whole.values()))
    )
    row = F.coalesce(cells.cast("variant"), F.parse_json(F.lit("null")))
    return _blocks(trades.select(row.alias("cells")), "trades", names, rows)


def faulty_responses(trades: DataFrame, rows: int = 500) -> DataFrame:
    """Trades as response texts by ranges of numbers, four of ten kinds unreadable:
    cut off, empty, with a row that is no array, and no object at all."""
    names = ["TRADENO", "TRADETIME", "SECID"]
    cells = F.array(*(F.col(n.lower()).cast("variant") for n in names))
    number = floor_div(F.col("tradeno"), rows)
    header = F.array(*(F.lit(name) for name in names))
    block = F.struct(header.alias("columns"), F.col("data"))
    text = F.to_json(F.struct(block.alias("trades")))
    kind = F.pmod("number", F.lit(10))
    return (
        trades.groupBy(number.alias("number"))
        .agg(F.collect_list(cells).alias("data"))
        .select(
            F.when(kind == 3, F.substring(text, 1, F.length(text) - 3))
            .when(kind == 5, "")
            .when(kind == 7, F.replace(text, F.lit('"data":['), F.lit('"data":[5,')))
            .when(kind == 9, "[1]")
            .otherwise(text)
            .alias("value")
        )
    )


def outsized_responses(trades: DataFrame, rows: int = PAGE_SIZE) -> DataFrame:
    """Responses in which some prices and values do not fit their types."""
    names = ["TRADENO", "TRADETIME", "SECID", "BOARDID", "PRICE", "QUANTITY", "VALUE"]
    whole = {n: F.col(n.lower()).cast("variant") for n in names}
    part = F.pmod("tradeno", F.lit(10))

    def sent(**changed: float) -> Column:
        cells = {**whole, **{n: F.lit(v).cast("variant") for n, v in changed.items()}}
        return F.array(*cells.values())

    cells = (
        F.when(part == 1, sent(PRICE=1234567890123.5))
        .when(part == 2, sent(VALUE=1e30))
        .when(part == 3, sent(PRICE=1e-9))
        .otherwise(F.array(*whole.values()))
    )
    return _blocks(trades.select(cells.alias("cells")), "trades", names, rows)


def overlapping_files(trades: DataFrame, folder: str) -> int:
    """Trades landed three times over: each of three folders has two thirds of the keys,
    in no order of time. All copies of a key lie together. Returns the number of files of
    a folder, of which there are more the more trades there are."""
    parts = max(4, -(-trades.count() * 2 // (3 * FILE_ROWS)))
    third = F.pmod(F.xxhash64("secid", "tradeno"), F.lit(3))
    for i in range(3):
        part = trades.filter((third == i) | (third == (i + 1) % 3))
        part.repartition(parts, "secid", "tradeno").write.parquet(f"{folder}/{i}")
    return parts


def landed_stream(spark: SparkSession, schema: StructType, folder: str, parts: int) -> DataFrame:
    """What ``overlapping_files`` landed, a folder of ``parts`` files per micro-batch."""
    return (
        spark.readStream.schema(schema)
        .option("recursiveFileLookup", "true")
        .option("maxFilesPerTrigger", parts)
        .parquet(folder)
    )


def security_responses(securities: DataFrame, rows: int = PAGE_SIZE) -> DataFrame:
    names = ["SECID", "BOARDID", "SHORTNAME", "SECNAME", "PREVPRICE", "LOTSIZE"]
    cells = F.array(*(F.col(n.lower()).cast("variant") for n in names))
    return _blocks(securities.select(cells.alias("cells")), "securities", names, rows)
