"""Every operator applied to the given tables, by name.

Each entry is ``(spark, sf_dir) -> DataFrame`` and covers its whole table.
Decimals leave as DOUBLE, so that engines with other decimal rules compare
them; where exact digits matter they leave as text as well.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions import scalars as fn
from tickweave.operators import cursor, cycles, dedup, paging, selection
from tickweave.plans import loads, views
from tickweave.plans.archive import TradeArchive
from tickweave.plans.state import CollectorState
from tickweave.settings import (
    ALL,
    INSTRUMENTS_TOPIC,
    SPECIFIC,
    TRADES_TOPIC,
    UNCOUNTED,
    Settings,
    defaults,
    tune,
)
from tickweave.sinks.messages import FileSink, sink_securities, sink_trades
from tickweave.sources import envelope, topic
from tickweave.storage import scratch
from tickweave.streaming import collector

Query = Callable[[SparkSession, str], DataFrame]

SYMBOL = "purchase"
SYMBOLS = ["click", "purchase"]
START = datetime(2024, 1, 8)
TILL = datetime(2024, 1, 19, 12, 30, 45, 500_000)
INGEST = datetime(2024, 2, 1, 0, 0, 0, 123_000)
NOW = datetime(2024, 2, 1, 8, 15, 30, 250_000)
LINE_RESTART = datetime(1996, 1, 1)
CYCLES_START = datetime(2024, 1, 1)
CYCLES_NOW = datetime(2024, 1, 31)
CYCLE_MINUTES = 5 * 24 * 60
RUN_START = datetime(2024, 1, 1, 0, 0, 0, 700_000)
RUN_NOW = datetime(2024, 1, 30, 23, 59, 58, 900_000)

_QUERIES: dict[str, Query] = {}


def query(work: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _plain(work(tune(spark), sf_dir))

    _QUERIES[work.__name__] = run
    return work


def _plain(df: DataFrame) -> DataFrame:
    return df.select(
        *(
            F.col(f.name).cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f.name)
            for f in df.schema.fields
        )
    )


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.event_trades(views.table(spark, sf_dir, "events"))


def _shown(trades: DataFrame) -> DataFrame:
    """The columns a trade of ``events`` fills."""
    return trades.drop("period", "tradingsession", "systime", "ts_offset")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.lineitem_trades(views.table(spark, sf_dir, "lineitem"))


def _securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.part_securities(views.table(spark, sf_dir, "part"))


def _cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.daily_cycles(_trades(spark, sf_dir))


def _envelopes(responses: DataFrame) -> DataFrame:
    return responses.select("value")


# Sources and decoding


@query
def read_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch(spark, "landing")
    trades = views.trade_responses(_trades(spark, sf_dir))
    securities = views.security_responses(_securities(spark, sf_dir))
    trades.unionByName(securities).write.text(path)
    landed = envelope.read_envelope(spark, path, layout="line")
    return (
        envelope.block_rows(landed, "trades", envelope.TRADE_POSITIONS)
        .select(F.lit("trades").alias("block"))
        .unionByName(
            envelope.block_rows(
                landed, "securities", envelope.SECURITY_POSITIONS
            ).select(F.lit("securities").alias("block"))
        )
        .groupBy("block")
        .agg(F.count(F.lit(1)).alias("n_rows"))
    )


@query
def decode_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = views.trade_responses(_trades(spark, sf_dir))
    return _shown(envelope.decode_trades(_envelopes(responses)))


@query
def decode_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long responses, a file each, read by byte ranges."""
    landing = scratch(spark, "landing")
    responses = views.trade_responses(_trades(spark, sf_dir), 50_000)
    # Several responses may meet in one task, and a file is read as one response.
    responses.write.option("lineSep", " ").option("maxRecordsPerFile", 1).text(landing)
    return _shown(envelope.decode_trades(envelope.read_envelope(spark, landing, layout="split")))


@query
def decode_securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = views.security_responses(_securities(spark, sf_dir))
    return envelope.decode_securities(_envelopes(responses)).select(
        "secid", "boardid", "shortname", "secname", "prevprice", "lotsize"
    )


@query
def drop_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = views.broken_responses(_trades(spark, sf_dir))
    rows = envelope.block_rows(
        _envelopes(responses), "trades", envelope.TRADE_POSITIONS
    )
    return rows.groupBy(F.size("cells").alias("n_cells")).agg(
        F.count(F.lit(1)).alias("n_rows")
    )


@query
def default_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = views.broken_responses(_trades(spark, sf_dir))
    return _shown(envelope.decode_trades(_envelopes(responses))).drop("buysell")


@query
def decode_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = _trades(spark, sf_dir)
    responses = views.broken_responses(trades).union(views.faulty_responses(trades))
    return envelope.decode_report(envelope.decode_all_trades(_envelopes(responses)))


@query
def unreadable_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed responses of which some cannot be read: rows, and responses lost."""
    path = scratch(spark, "landing")
    views.faulty_responses(_trades(spark, sf_dir)).write.text(path)
    landed = envelope.read_envelope(spark, path, layout="line")
    return (
        envelope.decode_all_trades(landed)
        .groupBy(F.coalesce("fault", F.lit("none")).alias("fault"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


@query
def decode_out_of_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every trade sent, with its price, or as one whose number does not fit."""
    responses = views.outsized_responses(_trades(spark, sf_dir))
    sent = F.from_json("sent", "array<string>")
    return envelope.decode_all_trades(_envelopes(responses)).select(
        F.coalesce(sent[0].cast("bigint"), "tradeno").alias("tradeno"),
        F.coalesce("fault", F.lit("none")).alias("fault"),
        F.when(F.col("fault").isNull(), F.col("price")).alias("price"),
    )


@query
def list_securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    landing = scratch(spark, "landing")
    views.security_responses(_securities(spark, sf_dir)).write.text(
        f"{landing}/stock/shares/securities"
    )
    return envelope.list_securities(spark, landing, layout="line").select(
        "secid", "boardid", "shortname", "secname", "prevprice", "lotsize"
    )


@query
def scan_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = FileSink(scratch(spark, "topic"))
    sink_trades(_trades(spark, sf_dir), sink, INGEST)
    return topic.scan_topic(topic.read_topic(spark, sink.path, TRADES_TOPIC))


@query
def topic_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = FileSink(scratch(spark, "topic"))
    sink_trades(_trades(spark, sf_dir), sink, INGEST)
    messages = topic.read_topic(spark, sink.path, TRADES_TOPIC)
    return topic.topic_counts(messages, sink.partitions[TRADES_TOPIC])


# Projections, filters, scalar functions


@query
def filter_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.filter_symbol(_shown(_trades(spark, sf_dir)), SYMBOL)


@query
def filter_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.filter_symbols(_shown(_trades(spark, sf_dir)), SYMBOLS)


@query
def filter_symbols_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Instruments named by a table: those that ever traded above 350."""
    trades = _shown(_trades(spark, sf_dir))
    wanted = selection.distinct_securities(trades.filter(F.col("price") > 350))
    return selection.filter_symbols(trades, wanted)


@query
def filter_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.filter_time_range(_shown(_trades(spark, sf_dir)), START, TILL)


@query
def filter_symbol_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.filter_symbol_time_range(
        _shown(_trades(spark, sf_dir)), SYMBOL, START, TILL
    )


@query
def total_volume(spark: SparkSession, sf_dir: str) -> DataFrame:
    volume = fn.total_volume()
    return _trades(spark, sf_dir).select(
        "secid",
        "tradeno",
        volume.alias("total_volume"),
        volume.cast("string").alias("digits"),
    )


@query
def ingest_millis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trades(spark, sf_dir).select(
        "secid", "tradeno", fn.ingest_millis(INGEST).alias("ingested")
    )


@query
def message_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select(fn.message_key().alias("key"))


@query
def format_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trades(spark, sf_dir).select(
        "tradeno", fn.format_time(F.col("trade_ts")).alias("bound")
    )


@query
def start_of_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trades(spark, sf_dir).select(
        "tradeno", fn.start_of_day(F.col("trade_ts")).alias("midnight")
    )


@query
def trade_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _trades(spark, sf_dir).select(
        "tradeno", fn.trade_json(INGEST).alias("message")
    )


@query
def security_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _securities(spark, sf_dir).select(
        "secid", fn.security_json().alias("message")
    )


# Sort, limit, top-k, paging


@query
def latest_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.latest_trades(_shown(_trades(spark, sf_dir)))


@query
def latest_trades_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.latest_trades_symbol(_shown(_trades(spark, sf_dir)), SYMBOL)


@query
def trades_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.trades_page(_shown(_trades(spark, sf_dir)), limit=2000, start=3000)


@query
def trades_page_deep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page found by positions, over trades with repeated keys and times."""
    return paging.trades_page(
        _lines(spark, sf_dir), limit=5000, start=20_000, reverse=False, sort_rows=0
    )


@query
def trades_range_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.trades_range_page(
        _shown(_trades(spark, sf_dir)), START, TILL, limit=1000, start=500
    )


@query
def drain_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.drain_range(_shown(_trades(spark, sf_dir)), START, TILL)


@query
def drain_range_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.drain_range_symbol(
        _shown(_trades(spark, sf_dir)), SYMBOL, START, TILL
    )


@query
def page_assignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page_assignment(_lines(spark, sf_dir))


@query
def page_assignment_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All instruments paged together, in pages of 500."""
    return paging.page_assignment(_trades(spark, sf_dir), 500, per_symbol=False)


@query
def page_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return paging.page_count(_lines(spark, sf_dir))


# Joins and set operations


@query
def filter_new_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = _lines(spark, sf_dir)
    return dedup.filter_new_trades(trades, views.seen_before(trades, LINE_RESTART))


@query
def dedup_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.dedup_trades(_lines(spark, sf_dir))


@query
def union_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.union_symbols(_shown(_trades(spark, sf_dir)), SYMBOLS)


@query
def distinct_securities(spark: SparkSession, sf_dir: str) -> DataFrame:
    return selection.distinct_securities(_securities(spark, sf_dir))


# Aggregations


@query
def cycle_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed with whole minutes, so that trades fall on window borders."""
    minute = F.date_trunc("minute", "trade_ts").cast("timestamp_ntz")
    trades = _trades(spark, sf_dir)
    return cycles.cycle_log(
        trades.withColumn("trade_ts", minute),
        views.seen_before(trades),
        RUN_START,
        RUN_NOW,
        page_size=2,
    )


@query
def metrics_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.metrics_totals(_cycles(spark, sf_dir))


@query
def metrics_running(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.metrics_running(_cycles(spark, sf_dir), block=7)


@query
def metrics_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.metrics_avg(_cycles(spark, sf_dir))


@query
def last_cycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.last_cycle(_cycles(spark, sf_dir), NOW)


@query
def error_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cycles.error_count(_cycles(spark, sf_dir))


@query
def seen_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.seen_counts(dedup.bounded_seen_set(_lines(spark, sf_dir)))


@query
def collector_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = cursor.collector_status(_cycles(spark, sf_dir), NOW, SPECIFIC, SYMBOLS)
    return status.withColumn(
        "configured_tickers", F.concat_ws(",", "configured_tickers")
    )


# Stateful and incremental operators


@query
def bounded_seen_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.bounded_seen_set(_lines(spark, sf_dir))


@query
def mark_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = _lines(spark, sf_dir)
    seen = dedup.bounded_seen_set(views.seen_before(trades, LINE_RESTART))
    batch = trades.filter(F.col("trade_ts") > fn.ntz(LINE_RESTART))
    return dedup.mark_batch(seen, batch)


@query
def filter_unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``filter_new_trades`` against bitmaps of the numbers seen."""
    trades = _lines(spark, sf_dir)
    return dedup.filter_unseen(trades, dedup.seen_bitmaps(views.seen_before(trades, LINE_RESTART)))


@query
def mark_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bitmaps after a batch was added, as rows again."""
    trades = _lines(spark, sf_dir)
    seen = dedup.seen_bitmaps(views.seen_before(trades, LINE_RESTART))
    batch = trades.filter(F.col("trade_ts") > fn.ntz(LINE_RESTART))
    return dedup.bitmap_keys(dedup.mark_bitmaps(seen, batch))


@query
def bitmap_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup.bitmap_counts(dedup.seen_bitmaps(_lines(spark, sf_dir)))


@query
def cursor_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cursor.cursor_state(_cycles(spark, sf_dir), NOW)


@query
def cursor_advance(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = _cycles(spark, sf_dir)
    state = cursor.cursor_state(log, NOW)
    bounds = state.select(
        "run_id",
        F.col("last_trade_time").alias("from_ts"),
        fn.ntz(NOW).alias("now_ts"),
    )
    return cursor.cursor_advance(state, cycles.catchup_windows(bounds), NOW)


@query
def cursor_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cursor.cursor_totals(_cycles(spark, sf_dir))


def _loaded(trades: DataFrame) -> DataFrame:
    return trades.select(
        fn.message_key().alias("key"),
        "secid",
        "tradeno",
        "trade_ts",
        fn.total_volume().alias("total_volume"),
    )


@query
def initial_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _loaded(loads.initial_load(_trades(spark, sf_dir), START, TILL, SYMBOLS))


@query
def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    trades = _trades(spark, sf_dir)
    seen = views.seen_before(trades)
    return _loaded(loads.incremental_load(trades, seen, START, TILL, SYMBOLS))


def _collected(spark: SparkSession, trades: DataFrame | loads.Landed, most_windows: int = 1) -> DataFrame:
    state = CollectorState(scratch(spark, "collector"))
    sink = FileSink(f"{state.root}/topic")
    job = Settings(mode=ALL, seen_cap=None, catch_up_minutes=CYCLE_MINUTES)
    moment, row = CYCLES_START, {"till": None}
    while row["till"] != CYCLES_NOW:
        row = loads.run_cycle(trades, state, sink, job, clock=lambda: moment, most_windows=most_windows)
        moment = CYCLES_NOW
    return _logged(spark, state, sink)


def _logged(spark: SparkSession, state: CollectorState, sink: FileSink) -> DataFrame:
    """The log of a collector, and what it sent in each cycle."""
    key = F.split("key", ":")
    sent = (
        topic.read_topic(spark, sink.path, TRADES_TOPIC)
        .groupBy(F.col("batch_id").alias("cycle"))
        .agg(
            F.count_distinct("key").alias("sent"),
            F.sum(key[1].cast("bigint")).alias("sum_tradeno"),
        )
    )
    nothing = F.lit(0).cast("bigint")
    return (
        state.read_cycles(spark)
        .join(sent, "cycle", "left")
        .withColumns({c: F.coalesce(c, nothing) for c in ("sent", "sum_tradeno")})
    )


@query
def collector_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The job itself over the whole table: an initial load at the first midnight,
    then cycles of five days. The log it keeps, and what it sent in each cycle."""
    return _collected(spark, _trades(spark, sf_dir))


def _landed(spark: SparkSession, sf_dir: str) -> loads.Landed:
    """All trades landed as responses of 500 rows in eight files, three per micro-batch."""
    landing = scratch(spark, "landing")
    responses = views.trade_responses(_trades(spark, sf_dir), 500)
    responses.repartition(8).write.text(f"{landing}/stock/shares/trades")
    stream = {"layout": "line", "streaming": True, "faults": True, "maxFilesPerTrigger": "3"}
    return loads.Landed(
        spark,
        TradeArchive(scratch(spark, "archive"), width=24),
        lambda: envelope.list_trades(spark, landing, **stream),
    )


def _archived(spark: SparkSession, sf_dir: str) -> TradeArchive:
    landed = _landed(spark, sf_dir)
    landed.archive.absorb(landed.stream(), Settings())
    return landed.archive


@query
def archive_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The trades of a range from the hours of the archive."""
    found = _archived(spark, sf_dir).window(spark, START, TILL)
    return _shown(found).drop("is_defaulted")


@query
def archive_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = _archived(spark, sf_dir).latest(spark)
    return _shown(found).drop("is_defaulted")


@query
def archive_page(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page located by the counts that were kept."""
    found = _archived(spark, sf_dir).page(spark, limit=2000, start=3000)
    return _shown(found).drop("is_defaulted")


@query
def archive_cycles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``collector_cycles`` from landed responses, each decoded once; the windows are taken
    together where that can be, and what is read are the folders that they touch."""
    return _collected(spark, _landed(spark, sf_dir), most_windows=501)


@query
def collector_restart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A loaded topic after a second start with a state of its own: how often each
    message is there. A start sends again, and replaces nothing."""
    sink = FileSink(scratch(spark, "topic"))
    job = Settings(mode=ALL, seen_cap=None, catch_up_minutes=10 * CYCLE_MINUTES)
    trades = _trades(spark, sf_dir)
    for start in ("first", "second"):
        state = CollectorState(scratch(spark, start))
        for moment in (CYCLES_START, CYCLES_NOW):
            loads.run_cycle(trades, state, sink, job, clock=lambda moment=moment: moment)
    sent = topic.read_topic(spark, sink.path, TRADES_TOPIC)
    return sent.groupBy("key").agg(F.count(F.lit(1)).alias("copies"))


@query
def catchup_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each instrument's windows from its last trade before the restart to its
    newest trade."""
    known = F.when(F.col("trade_ts") <= fn.ntz(views.RESTART), F.col("trade_ts"))
    bounds = (
        _trades(spark, sf_dir)
        .groupBy("secid")
        .agg(F.max(known).alias("from_ts"), F.max("trade_ts").alias("now_ts"))
    )
    return cycles.catchup_windows(bounds)


# Sinks


@query
def sink_trades_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = FileSink(scratch(spark, "topic"))
    sink_trades(_trades(spark, sf_dir), sink, INGEST)
    return topic.read_topic(spark, sink.path, TRADES_TOPIC)


@query
def sink_securities_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    sink = FileSink(scratch(spark, "topic"))
    sink_securities(_securities(spark, sf_dir), sink)
    return topic.read_topic(spark, sink.path, INSTRUMENTS_TOPIC)


# Streams


@query
def stream_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem``, whose keys repeat, in three overlapping parts, a micro-batch
    each, through the collector; what it sent."""
    state = CollectorState(scratch(spark, "collector"))
    sink = FileSink(f"{state.root}/topic")
    landing = scratch(spark, "landing")
    trades = views.full_trades(_lines(spark, sf_dir))
    parts = views.overlapping_files(trades, landing)
    stream = views.landed_stream(spark, trades.schema, landing, parts)
    job = Settings(mode=ALL, seen_cap=None)
    collector.stream_trades(stream, state, sink, job, once=True).awaitTermination()
    sent = topic.read_topic(spark, sink.path, TRADES_TOPIC)
    return _loaded(topic.message_trades(sent))


@query
def stream_watermark(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same files through time-bounded de-duplication: late and repeated rows,
    and every seventh key without a time. Each key arrives once."""
    root = scratch(spark, "watermark")
    timeless = F.col("tradeno") % 7 != 0
    trades = _lines(spark, sf_dir).withColumn("trade_ts", F.when(timeless, F.col("trade_ts")))
    parts = views.overlapping_files(trades, f"{root}/landing")
    stream = views.landed_stream(spark, trades.schema, f"{root}/landing", parts)
    with defaults(spark, UNCOUNTED):
        (
            collector.dedup_stream(stream)
            .writeStream.format("parquet")
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start(f"{root}/trades")
            .awaitTermination()
        )
    return spark.read.parquet(f"{root}/trades").select("secid", "tradeno")


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _QUERIES["incremental_load"](spark, sf_dir)


def queries() -> dict[str, Query]:
    named = dict(_QUERIES)
    named["sink_trades"] = named.pop("sink_trades_topic")
    named["sink_securities"] = named.pop("sink_securities_topic")
    return named
