"""Landed responses as a table of trades by hour, each response decoded once.

What has landed since the last call is decoded by a stream that ends when it has taken
everything; its checkpoint is the manifest of the files that are done. Trades go to
folders by hour of trade, and the number of trades per hour is kept beside them. A window of time, the
newest trades, or a page far down then read the hours they touch, however long the
history is.

A micro-batch that is done again has the same files and replaces its own folders.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.errors import AnalysisException, StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions.scalars import floor_div, micros_between, ntz, whole_second
from tickweave.operators.paging import EPOCH, located, trades_page
from tickweave.operators.selection import filter_symbol, filter_time_range
from tickweave.schemas import TRADE
from tickweave.settings import FAIL, LATEST_LIMIT, PAGE_SIZE, Settings
from tickweave.sources.envelope import sound

HOUR = 3_600_000_000  # microseconds
TIMELESS = "__HIVE_DEFAULT_PARTITION__"  # the folder of trades without a time

STORED = T.StructType([*TRADE.fields, T.StructField("is_defaulted", T.BooleanType())])
PLACED = T.StructType(
    [*STORED.fields, T.StructField("hour", T.LongType()), T.StructField("batch", T.LongType())]
)
TOTALS = "hour bigint, n bigint, batch bigint"
FAULTS = "file string, fault string, sent string, batch bigint"


class UnreadableInput(RuntimeError):
    """Responses, or numbers in them, that a cycle must not pass over."""


def refuse(faults: DataFrame) -> None:
    """Raise if there is any fault."""
    first = faults.limit(5).collect()
    if first:
        named = "; ".join(f"{row.fault} in {row.file}" for row in first)
        raise UnreadableInput(f"{faults.count()} unreadable, such as: {named}")


@dataclass(frozen=True)
class TradeArchive:
    """The tables below ``root``: ``trades`` by hour, ``totals`` and ``faults`` by batch."""

    root: str
    width: int = 1  # hours of a folder: more where little is traded or months come at once

    def _hour(self) -> Column:
        """The first hour of the folder of a trade, counted since 1970."""
        passed = micros_between(ntz(EPOCH), F.col("trade_ts"))
        return floor_div(passed, HOUR * self.width) * self.width

    def hour_of(self, moment: datetime) -> int:
        return (moment - EPOCH) // timedelta(hours=self.width) * self.width

    def absorb(self, landed: DataFrame, settings: Settings) -> list[int]:
        """Add what a stream of rows of ``decode_all_trades`` brings; the numbers of the
        micro-batches it took.

        Unreadable input fails, and the batch with it, which the next call does again; or
        it is kept in ``faults``, if the settings say so. Without anything new no batch
        is taken.
        """
        done: list[int] = []

        def add(batch: DataFrame, number: int) -> None:
            self._add(batch, number, settings)
            done.append(number)

        query = (
            landed.writeStream.foreachBatch(add)
            .option("checkpointLocation", f"{self.root}/manifest")
            .trigger(availableNow=True)
            .start()
        )
        try:
            query.awaitTermination()
        except StreamingQueryException as error:
            if "UnreadableInput" in str(error):
                raise UnreadableInput(str(error)) from error
            raise
        return done

    def _add(self, batch: DataFrame, number: int, settings: Settings) -> None:
        spark = batch.sparkSession
        path = f"{self.root}/incoming/slot={number % 2}"
        batch.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)
        decoded = spark.read.schema(batch.schema).parquet(path)
        if "fault" in decoded.columns:
            faults = decoded.filter(F.col("fault").isNotNull()).select("file", "fault", "sent")
            if settings.on_fault == FAIL:
                refuse(faults)
            kept = f"{self.root}/faults/batch={number}"
            faults.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(kept)
            decoded = sound(decoded)
        keys = {"hour": self._hour(), "batch": F.lit(number).cast("bigint")}
        trades = decoded.select(*STORED.fieldNames()).withColumns(keys)
        # An hour that holds most rows is cut into files by adaptive execution; in each
        # the trades lie by time, so a scan can pass over the groups of other minutes.
        dealt = trades.hint("rebalance", "hour").sortWithinPartitions("hour", "trade_ts")
        (
            dealt.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("hour", "batch")
            .parquet(f"{self.root}/trades")
        )
        totals = trades.groupBy("hour").agg(F.count(F.lit(1)).alias("n"))
        kept = f"{self.root}/totals/batch={number}"
        totals.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(kept)

    def _totals(self, spark: SparkSession) -> DataFrame:
        """Trades per hour and micro-batch."""
        try:
            return spark.read.schema(TOTALS).parquet(f"{self.root}/totals")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], TOTALS)

    def hours(self, spark: SparkSession) -> list[int]:
        """The hours that hold trades, from the names of the folders alone."""
        return sorted(int(name) for name in self._folders(spark) if name != TIMELESS)

    def _folders(self, spark: SparkSession) -> list[str]:
        home = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/trades")
        files = home.getFileSystem(spark._jsc.hadoopConfiguration())
        if not files.exists(home):
            return []
        names = [status.getPath().getName() for status in files.listStatus(home)]
        return [name[len("hour=") :] for name in names if name.startswith("hour=")]

    def trades(self, spark: SparkSession, hours: Sequence[int | str] | None = None) -> DataFrame:
        """All trades, or those in the folders of some hours, and no others."""
        hours = self._folders(spark) if hours is None else hours
        if not hours:
            return spark.createDataFrame([], STORED)
        home = f"{self.root}/trades"
        reader = spark.read.schema(PLACED).option("basePath", home)
        return reader.parquet(*(f"{home}/hour={hour}" for hour in hours)).select(*STORED.fieldNames())

    def window(self, spark: SparkSession, start: datetime, till: datetime) -> DataFrame:
        """The trades from ``start`` to ``till``, from the hours between them."""
        first, last = self.hour_of(whole_second(start)), self.hour_of(whole_second(till))
        touched = [hour for hour in self.hours(spark) if first <= hour <= last]
        return filter_time_range(self.trades(spark, touched), start, till)

    def faults(self, spark: SparkSession, batches: Sequence[int]) -> DataFrame:
        """What could not be read of some micro-batches: (file, fault, sent, batch)."""
        if not batches:
            return spark.createDataFrame([], FAULTS)
        home = f"{self.root}/faults"
        reader = spark.read.schema(FAULTS).option("basePath", home)
        return reader.parquet(*(f"{home}/batch={batch}" for batch in batches))

    def latest(self, spark: SparkSession, limit: int = LATEST_LIMIT, symbol: str | None = None) -> DataFrame:
        """The newest trades, over all instruments or of one, as ``latest_trades`` has them.

        The newest hour is looked at first, then twice as many each time, until enough
        trades are there: the older ones, and those without a time, cannot be newer.
        """
        ordered: list[int | str] = list(reversed(self.hours(spark)))
        ordered += [TIMELESS] if TIMELESS in self._folders(spark) else []
        taken = 1
        while True:
            near = self.trades(spark, ordered[:taken])
            if symbol is not None:
                near = filter_symbol(near, symbol)
            if taken >= len(ordered) or near.limit(limit).count() >= limit:
                return trades_page(near, limit)
            taken *= 2

    def page(
        self,
        spark: SparkSession,
        limit: int = PAGE_SIZE,
        start: int = 0,
        reverse: bool = True,
    ) -> DataFrame:
        """One page of all trades, the same rows as ``trades_page`` gives, located by the
        counts per hour that were kept when trades came in.

        Their sums say which hours the page touches, and trades are counted and read in
        these alone, so a page costs the same however long the history is.
        """
        totals = self._totals(spark).groupBy(F.col("hour").alias("slot")).agg(F.sum("n").alias("n"))
        touched = located(totals, limit, start, reverse)
        if touched["rows"] is None:
            return self.trades(spark, [])
        hours: list[int | str] = []
        if touched["first"] is not None:
            hours += [h for h in self.hours(spark) if touched["first"] <= h <= touched["last"]]
        hours += [TIMELESS] if touched["timeless"] else []
        return trades_page(self.trades(spark, hours), limit, start - touched["ahead"], reverse)
