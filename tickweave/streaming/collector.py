"""The collector as a Structured Streaming job."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import AbstractContextManager
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tickweave.operators.dedup import dedup_trades, filter_new_trades
from tickweave.operators.selection import filter_symbols
from tickweave.plans.loads import commit_cycle, failed, set_faults_aside
from tickweave.plans.state import CollectorState
from tickweave.settings import TRIGGER_SECONDS, Settings, defaults
from tickweave.sinks.messages import FileSink, KafkaSink


# Stored or shuffled trades take many times their bytes when a task sorts them.
SHORT = {
    "spark.sql.files.maxPartitionBytes": "8m",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
}


def _short_tasks(spark: SparkSession) -> AbstractContextManager[None]:
    """Tasks take little each, where the session names no sizes of its own."""
    return defaults(spark, SHORT)


def collect_batch(
    state: CollectorState,
    sink: FileSink | KafkaSink,
    settings: Settings,
    clock: Callable[[], datetime] = datetime.now,
    dedupe: bool = True,
) -> Callable[[DataFrame, int], None]:
    """The work on one micro-batch, for ``foreachBatch``.

    The batch id is the state version, so a batch delivered again reads the
    state its first attempt read and replaces what that attempt wrote. A failure
    is logged and raised, and the batch stays to be delivered again.
    """

    def work(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kind = "initial" if batch_id == 0 else "incremental"
        cycle = {"cycle": batch_id, "kind": kind, "started": clock()}
        own, _ = state.begin(spark, batch_id, kind)
        try:
            with _short_tasks(spark):
                _collect(own, sink, settings, clock, dedupe, batch, cycle)
        except Exception:
            failed(own, spark, {**cycle, "run_id": settings.run_id, "ended": clock()})
            raise

    return work


def _collect(
    state: CollectorState,
    sink: FileSink | KafkaSink,
    settings: Settings,
    clock: Callable[[], datetime],
    dedupe: bool,
    batch: DataFrame,
    cycle: dict,
) -> None:
    spark, batch_id = batch.sparkSession, cycle["cycle"]
    staged = state.stage_fetched(batch, batch_id)
    fetched = set_faults_aside(state, staged, batch_id, settings)
    bits = settings.seen_cap is None
    seen = state.read_seen(spark, batch_id - 1, state.buckets(fetched), bits)
    fresh = dedup_trades(fetched) if dedupe else fetched
    summary = fetched.agg(
        F.count(F.lit(1)).alias("n"), F.max("trade_ts").alias("newest")
    ).first()
    cursor = state.read_cursor(spark, cycle["started"])
    before = cursor if cursor["version"] < batch_id else None
    till = summary["newest"] or cursor["last_trade_time"]
    if cursor["initial_load_complete"]:
        till = max(till, cursor["last_trade_time"])
    cycle["till"] = till
    row = commit_cycle(
        state,
        sink,
        lambda: summary["n"],
        filter_new_trades(fresh, seen),
        cycle,
        settings,
        clock,
    )
    if before is None:
        return
    gained = batch_id == 0 or row["collected"] > 0
    state.write_cursor(
        spark,
        {
            "version": batch_id,
            "last_trade_time": till,
            "initial_load_complete": True,
            "total_trades_collected": before["total_trades_collected"] + row["collected"],
            "total_cycles_completed": before["total_cycles_completed"] + int(gained),
            "last_update_time": row["ended"],
        },
    )


def stream_trades(
    trades: DataFrame,
    state: CollectorState,
    sink: FileSink | KafkaSink,
    settings: Settings,
    once: bool = False,
    clock: Callable[[], datetime] = datetime.now,
    dedupe: bool = True,
    interval: float = TRIGGER_SECONDS,
) -> StreamingQuery:
    """Start collecting a stream of trades, or of rows of ``decode_all_trades``,
    whose faults are then counted as the settings say.

    ``once`` takes all that is there and stops, which is the initial load; the
    same call later goes on from the checkpoint. Otherwise a batch starts every
    few seconds. How much one batch takes is set on the source
    (``maxFilesPerTrigger``, ``maxOffsetsPerTrigger``).
    """
    pause = {"availableNow": True} if once else {
        "processingTime": f"{interval} seconds"
    }
    wanted = filter_symbols(trades, settings.selection())
    if "fault" in trades.columns and settings.selection() is not None:
        named = F.col("secid").isin(sorted(set(settings.selection())))
        wanted = trades.filter(named | F.col("fault").isNotNull())
    return (
        wanted.writeStream.foreachBatch(collect_batch(state, sink, settings, clock, dedupe))
        .option("checkpointLocation", f"{state.root}/checkpoint")
        .trigger(**pause)
        .start()
    )


def keep_collecting(
    start: Callable[[], StreamingQuery], tries: int, pause: float
) -> None:
    """Run a collector until it ends; after a failure start it again, from where it
    stopped, up to ``tries`` failures without a batch done between them."""
    failures = 0
    while True:
        query = start()
        try:
            query.awaitTermination()
            return
        except StreamingQueryException:
            failures = 1 if query.recentProgress else failures + 1
            if failures >= tries:
                raise
        time.sleep(pause)


def _once_a_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each key in every batch of rows, without any state."""
    for batch in batches:
        keys = pa.table({"s": batch.column("secid"), "n": batch.column("tradeno"), "at": np.arange(batch.num_rows)})
        first = keys.group_by(["s", "n"], use_threads=False).aggregate([("at", "min")])["at_min"]
        yield batch.take(np.sort(first.to_numpy()))


def dedup_stream(
    trades: DataFrame, delay: str = "30 days", slices: int | None = None
) -> DataFrame:
    """First arrival per key; a key is forgotten ``delay`` after it arrived.

    For key spaces too wide for a seen-set. Time is that of arrival, not of the
    trade: a late trade, or one without a time, is a row like any other and never
    dropped for its time. A copy that arrives more than ``delay`` after the first
    is delivered again.

    A streaming de-duplication moves every row to the task of its key. So that
    a key which repeats without end does not meet one task, its copies are first
    reduced inside each task, a batch of rows at a time, which needs no state: each key
    is kept once, in RocksDB with the settings of ``tune``. With ``slices`` copies are
    reduced per slice of the input as well, across batches, and each slice keeps the
    keys that it saw; ``slices=1`` reduces nothing before the shuffle.
    """
    if slices is None:
        trades = trades.mapInArrow(_once_a_batch, trades.schema)
    timed = trades.withColumn("_arrived", F.current_timestamp())
    first = timed.withWatermark("_arrived", delay)
    if slices is not None and slices > 1:
        part = F.pmod(F.spark_partition_id(), F.lit(slices))
        first = (
            first.withColumn("_slice", part)
            .dropDuplicatesWithinWatermark(["secid", "tradeno", "_slice"])
            .drop("_slice")
        )
    return first.dropDuplicatesWithinWatermark(["secid", "tradeno"]).drop("_arrived")
