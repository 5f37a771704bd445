"""Column-block JSON responses: reading them and decoding their rows.

A response holds named blocks, each a header (``columns``) and rows of untyped
cells (``data``). Cells are kept as VARIANT until the header says what they
are, so a number and a text that looks like one stay apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickweave.schemas import PRICE, TRADE, VALUE
from tickweave.sources.split import split_envelope

# Where a column is read when the header does not name it.
TRADE_POSITIONS = {
    "TRADENO": 0,
    "TRADETIME": 1,
    "SECID": 2,
    "BOARDID": 3,
    "PRICE": 4,
    "QUANTITY": 5,
    "VALUE": 6,
    "PERIOD": None,
    "TRADINGSESSION": None,
    "BUYSELL": None,
    "SYSTIME": None,
    "TS_OFFSET": None,
}
SECURITY_POSITIONS = {
    "SECID": 0,
    "BOARDID": 1,
    "SHORTNAME": None,
    "SECNAME": None,
    "PREVPRICE": None,
    "LOTSIZE": None,
    "FACEVALUE": None,
    "STATUS": None,
    "MARKETPRICE": None,
    "CURRENCYID": None,
}


def read_envelope(
    spark: SparkSession,
    path: str,
    layout: str = "file",
    streaming: bool = False,
    **options: str,
) -> DataFrame:
    """Landed responses, one per row: the ``file`` and the text, ``value``.

    ``layout="file"`` takes each file as one response, ``layout="line"`` each
    line, which lets Spark split large landing files. ``layout="split"`` reads each
    file as one response, by byte ranges, and gives its rows as several responses; not
    for streams. ``options`` go to the reader, such as ``maxFilesPerTrigger`` for a
    stream that has much to catch up on.
    """
    if layout == "split":
        if streaming:
            raise ValueError("a stream takes responses as files or lines")
        return split_envelope(spark, path)
    reader = spark.readStream if streaming else spark.read
    text = reader.format("text").option("wholetext", layout == "file")
    raw = text.options(**options).load(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), "value")


def _parsed(responses: DataFrame, block: str) -> DataFrame:
    """(file, _block, fault): the block of each response, or why it cannot be read.

    Only a cell is a VARIANT, so a response may be as long as a text can be; one
    that is longer fails the job. Responses may also come as ``envelope``
    VARIANT; a NULL one counts as unreadable.
    """
    text = F.col("value") if "value" in responses.columns else F.to_json("envelope")
    file = F.col("file") if "file" in responses.columns else F.lit(None).cast("string")
    shape = (
        f"struct<{block}:struct<columns:variant,data:array<array<variant>>>,"
        "_corrupt:string>"
    )
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    read = F.from_json(text, shape, options)
    start = F.ltrim(F.substring(text, 1, 64))
    # The texts themselves go no further. No filter stands above the parsed one:
    # pushed down to the scan, it would parse each text again.
    return responses.select(
        file.alias("file"), start.alias("_start"), read.alias("_read")
    ).select(
        "file",
        F.col(f"_read.{block}").alias("_block"),
        F.when(F.col("_start").isNull() | (F.col("_start") == ""), "empty response")
        .when(~F.col("_start").startswith("{"), "no JSON object")
        .when(F.col("_read._corrupt").isNotNull(), "broken JSON or block")
        .alias("fault"),
    )


def unreadable_responses(responses: DataFrame, block: str = "trades") -> DataFrame:
    """(file, fault) of the responses that give no rows because they cannot be read:
    empty ones, texts that are cut off or no JSON object, and blocks with a row
    that is no array. A missing block is no fault."""
    return _parsed(responses, block).select("file", "fault").filter("fault is not null")


def block_rows(
    envelopes: DataFrame, block: str, positions: dict, faults: bool = False
) -> DataFrame:
    """One row of ``cells`` per data row of ``block``, with the place of each column.

    A repeated header name counts where it stands last. A missing block or
    header, a row that is null, and a response that cannot be read give what the
    reading side of the wire format gives: nothing, positions, no row, and no
    rows. With ``faults`` each unreadable response is a row without cells that
    names its ``file`` and ``fault``.
    """
    names, columns = F.col("_names"), F.col("_block.columns")
    places = [
        F.coalesce(
            F.size(names)
            - F.nullif(F.array_position(F.reverse(names), F.lit(name)), F.lit(0)),
            F.lit(fallback).cast("bigint"),
        )
        .cast("int")
        .alias(name)
        for name, fallback in positions.items()
    ]
    sound = F.col("fault").isNull()
    # The outer explode lets Spark infer no filter on the parsed text.
    rows = (
        _parsed(envelopes, block)
        .select(
            "file",
            "fault",
            F.when(columns.isNull(), F.array().cast("array<string>"))
            .otherwise(F.try_variant_get(columns, "$", "array<string>"))
            .alias("_names"),
            F.when(sound, F.col("_block.data")).alias("_rows"),
        )
        .withColumn("_rows", F.when(names.isNotNull(), F.col("_rows")))
        .select("file", "fault", F.struct(*places).alias("_place"), "_rows")
        .select("file", "fault", "_place", F.explode_outer("_rows").alias("cells"))
    )
    if faults:
        return rows.filter(F.col("cells").isNotNull() | ~sound)
    return drop_malformed(rows.drop("file", "fault"))


def drop_malformed(rows: DataFrame) -> DataFrame:
    """Drop what cannot be read as a row of cells."""
    return rows.filter(F.col("cells").isNotNull())


def _cell(name: str) -> Column:
    return F.get("cells", F.col(f"_place.{name}"))


def _text(name: str) -> Column:
    return F.try_variant_get(_cell(name), "$", "string")


def _is_number(name: str) -> Column:
    family = F.substring(F.schema_of_variant(_cell(name)), 1, 3)
    return family.isin("BIG", "DOU", "FLO", "DEC")


def _number(name: str, kind: str) -> Column:
    """The cell as a number; anything that is no JSON number is NULL."""
    return F.when(_is_number(name), F.try_variant_get(_cell(name), "$", kind))


def _lost(name: str, kind: str) -> Column:
    """Whether a number was sent that the type cannot hold, or holds as 0."""
    kept, sent = _number(name, kind), F.try_variant_get(_cell(name), "$", "double")
    gone = kept.isNull() | ((kept == 0) & (F.abs(sent) > 0))
    if kind == "bigint":  # fractions are cut toward zero, which is no loss
        gone = kept.isNull()
    return F.coalesce(_is_number(name) & gone, F.lit(False))


def default_fill(fields: DataFrame) -> DataFrame:
    """Required fields never stay null: numbers become 0, texts become empty.

    ``is_defaulted`` tells that it happened to at least one of them.
    """
    numbers = ["tradeno", "price", "quantity", "value"]
    texts = ["tradetime", "secid", "boardid"]
    missing = F.lit(False)
    for name in numbers + texts:
        missing = missing | F.col(name).isNull()
    return (
        fields.withColumn("is_defaulted", missing)
        .fillna(0, ["tradeno", "quantity"])
        .withColumns(
            {
                "price": F.coalesce("price", F.lit(0).cast(PRICE)),
                "value": F.coalesce("value", F.lit(0).cast(VALUE)),
            }
        )
        .fillna("", texts)
    )


TRADE_NUMBERS = {
    "TRADENO": "bigint",
    "PRICE": PRICE.simpleString(),
    "QUANTITY": "bigint",
    "VALUE": VALUE.simpleString(),
}


def decode_all_trades(
    envelopes: DataFrame, trade_date: str | None = None
) -> DataFrame:
    """The ``trades`` block as typed rows, and beside them what cannot be one.

    ``fault`` is NULL for a trade. Else the row says which ``file`` could not be
    read and why, or that a number of this trade does not fit its type; ``sent``
    then holds the cells as they came, and no column may be trusted.
    """
    stamp = F.col("tradetime")
    if trade_date is not None:
        stamp = F.concat_ws(" ", F.lit(trade_date), stamp)
    lost = F.lit(False)
    for name, kind in TRADE_NUMBERS.items():
        lost = lost | _lost(name, kind)
    fields = (
        block_rows(envelopes, "trades", TRADE_POSITIONS, faults=True)
        .withColumn("fault", F.coalesce("fault", F.when(lost, "number out of range")))
        .select(
            *(
                _number(name, kind).alias(name.lower())
                for name, kind in TRADE_NUMBERS.items()
            ),
            _text("TRADETIME").alias("tradetime"),
            _text("SECID").alias("secid"),
            _text("BOARDID").alias("boardid"),
            _text("PERIOD").alias("period"),
            _text("TRADINGSESSION").alias("tradingsession"),
            _text("BUYSELL").alias("buysell"),
            _text("SYSTIME").alias("systime"),
            _number("TS_OFFSET", "bigint").alias("ts_offset"),
            "file",
            "fault",
            F.when(F.col("fault").isNotNull(), F.to_json("cells")).alias("sent"),
        )
    )
    names = [f.name for f in TRADE.fields if f.name != "trade_ts"]
    return (
        default_fill(fields)
        .withColumn("trade_ts", stamp.try_cast("timestamp_ntz"))
        .select(*names, "is_defaulted", "trade_ts", "file", "fault", "sent")
    )


def sound(decoded: DataFrame) -> DataFrame:
    """The trades among decoded rows."""
    return decoded.filter(F.col("fault").isNull()).drop("file", "fault", "sent")


def decode_trades(envelopes: DataFrame, trade_date: str | None = None) -> DataFrame:
    """The ``trades`` block as typed rows.

    ``trade_ts`` is NULL where the time does not parse. For a feed that sends
    the time of day alone, ``trade_date`` supplies the day. A trade with a
    number that its type cannot hold is left out and not sent as 0;
    ``decode_all_trades`` shows it, as well as responses that cannot be read.
    """
    return sound(decode_all_trades(envelopes, trade_date))


def decode_securities(envelopes: DataFrame) -> DataFrame:
    """The ``securities`` block as typed rows."""
    fields = block_rows(envelopes, "securities", SECURITY_POSITIONS).select(
        _text("SECID").alias("secid"),
        _text("BOARDID").alias("boardid"),
        _text("SHORTNAME").alias("shortname"),
        _text("SECNAME").alias("secname"),
        _number("PREVPRICE", PRICE.simpleString()).alias("prevprice"),
        _number("LOTSIZE", "int").alias("lotsize"),
        _number("FACEVALUE", PRICE.simpleString()).alias("facevalue"),
        _text("STATUS").alias("status"),
        _number("MARKETPRICE", PRICE.simpleString()).alias("marketprice"),
        _text("CURRENCYID").alias("currencyid"),
    )
    return fields.fillna("", ["secid", "boardid"])


def decode_report(trades: DataFrame) -> DataFrame:
    """How many decoded rows were defaulted or have no usable time. From rows of
    ``decode_all_trades`` also how many responses could not be read and how many
    trades have a number out of range."""
    trade = F.lit(True)
    more = []
    if "fault" in trades.columns:
        trade = F.col("fault").isNull()
        out = F.col("fault") == "number out of range"
        more = [
            F.count_if(~trade & ~out).alias("unreadable"),
            F.count_if(~trade & out).alias("out_of_range"),
        ]
    return trades.agg(
        F.count_if(trade).alias("n_rows"),
        F.count_if(trade & F.col("is_defaulted")).alias("defaulted"),
        F.count_if(trade & F.col("trade_ts").isNull()).alias("without_time"),
        *more,
    )


def landed(landing: str, engine: str, market: str, block: str) -> str:
    """Where the responses of one engine and market are landed."""
    return f"{landing}/{engine}/{market}/{block}"


def list_securities(
    spark: SparkSession,
    landing: str,
    engine: str = "stock",
    market: str = "shares",
    layout: str = "file",
) -> DataFrame:
    """All instruments landed for one engine and market."""
    path = landed(landing, engine, market, "securities")
    return decode_securities(read_envelope(spark, path, layout))


def list_trades(
    spark: SparkSession,
    landing: str,
    engine: str = "stock",
    market: str = "shares",
    layout: str = "file",
    streaming: bool = False,
    trade_date: str | None = None,
    faults: bool = False,
    **options: str,
) -> DataFrame:
    """All trades landed for one engine and market, as a table or a stream; with
    ``faults`` beside what cannot be read, as ``decode_all_trades`` gives it."""
    path = landed(landing, engine, market, "trades")
    decode = decode_all_trades if faults else decode_trades
    return decode(read_envelope(spark, path, layout, streaming, **options), trade_date)
