"""Keyed JSON messages, and the two places they can go."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickweave.functions.scalars import message_key, security_json, trade_json
from tickweave.settings import INSTRUMENTS_TOPIC, TOPIC_PARTITIONS, TRADES_TOPIC


def trade_messages(
    trades: DataFrame,
    ingest_ts: datetime | None = None,
    topic: str = TRADES_TOPIC,
    extra: Sequence[Column] = (),
) -> DataFrame:
    return trades.select(
        F.lit(topic).alias("topic"),
        message_key().alias("key"),
        trade_json(ingest_ts).alias("value"),
        *extra,
    )


def security_messages(
    securities: DataFrame, topic: str = INSTRUMENTS_TOPIC
) -> DataFrame:
    return securities.select(
        F.lit(topic).alias("topic"),
        F.col("secid").alias("key"),
        security_json().alias("value"),
    )


def key_partition(key: Column, partitions: Column) -> Column:
    """A partition number that depends on the key alone.

    Taken from MD5, which other engines can repeat; a broker picks its own.
    """
    head = F.conv(F.substring(F.md5(key.cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.pmod(head, partitions).cast("int")


@dataclass(frozen=True)
class FileSink:
    """Messages as Parquet, one folder per topic, generation and batch.

    A batch that is written again replaces its own folder, also when it has
    nothing left to say, so a replay leaves no second copy. Batches of another
    generation, such as those of a new start, are other folders.
    """

    path: str
    partitions: dict[str, int] = field(default_factory=lambda: dict(TOPIC_PARTITIONS))
    generation: str = "none"
    topic: str | None = None

    def to(self, topic: str) -> FileSink:
        """The same place, for messages of one topic."""
        return replace(self, topic=topic)

    def write(self, messages: DataFrame, batch_id: int = 0) -> None:
        """Without a single ``topic`` the folders of all topics that the messages
        name are replaced. Messages with a ``batch_id`` of their own replace the
        folders of the batches that they name."""
        count = F.lit(1)
        for topic, n in self.partitions.items():
            count = F.when(F.col("topic") == topic, F.lit(n)).otherwise(count)
        dealt = messages.withColumn("partition", key_partition(F.col("key"), count))
        if "batch_id" in messages.columns:
            (
                dealt.withColumn("generation", F.lit(self.generation))
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy("topic", "generation", "batch_id")
                .parquet(self.path)
            )
            return
        if self.topic is not None:
            place = f"topic={self.topic}/generation={self.generation}/batch_id={batch_id}"
            (
                dealt.drop("topic")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "static")
                .parquet(f"{self.path}/{place}")
            )
            return
        (
            dealt.withColumns(
                {
                    "generation": F.lit(self.generation),
                    "batch_id": F.lit(batch_id).cast("bigint"),
                }
            )
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("topic", "generation", "batch_id")
            .parquet(self.path)
        )


@dataclass(frozen=True)
class KafkaSink:
    """Messages to a broker, at least once. Needs the Kafka connector JAR."""

    servers: str = "localhost:9092"
    options: dict[str, str] = field(
        default_factory=lambda: {"kafka.acks": "all", "kafka.retries": "3"}
    )
    generation: str = "none"

    def to(self, topic: str) -> KafkaSink:
        return self

    def write(self, messages: DataFrame, batch_id: int = 0) -> None:
        (
            messages.select("topic", "key", "value")
            .write.format("kafka")
            .option("kafka.bootstrap.servers", self.servers)
            .options(**self.options)
            .save()
        )


def sink_trades(
    trades: DataFrame,
    sink: FileSink | KafkaSink,
    ingest_ts: datetime | None = None,
    batch_id: int | Column = 0,
) -> None:
    """Send trades as one batch, or each with the batch that a column names."""
    if isinstance(batch_id, Column):
        named = batch_id.cast("bigint").alias("batch_id")
        sink.to(TRADES_TOPIC).write(trade_messages(trades, ingest_ts, extra=(named,)))
        return
    sink.to(TRADES_TOPIC).write(trade_messages(trades, ingest_ts), batch_id)


def sink_securities(
    securities: DataFrame, sink: FileSink | KafkaSink, batch_id: int = 0
) -> None:
    sink.to(INSTRUMENTS_TOPIC).write(security_messages(securities), batch_id)
