"""Reading a topic: from a broker, or from the files of the file sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.schemas import MESSAGE, TRADE, VOLUME


def read_kafka(
    spark: SparkSession,
    servers: str,
    topic: str,
    streaming: bool = False,
    **options: str,
) -> DataFrame:
    """A broker topic from its beginning. Needs the Kafka connector JAR.

    ``options`` go to the reader, such as ``maxOffsetsPerTrigger`` or other
    ``startingOffsets``.
    """
    reader = spark.readStream if streaming else spark.read
    return (
        reader.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
        .load()
        .select(
            F.col("key").cast("string"),
            F.col("value").cast("string"),
            "partition",
            "offset",
            "topic",
        )
    )


def read_topic(
    spark: SparkSession, path: str, topic: str, streaming: bool = False
) -> DataFrame:
    """A topic kept as files; only its own folders are listed into the scan."""
    reader = spark.readStream if streaming else spark.read
    held = reader.schema(MESSAGE).parquet(path).filter(F.col("topic") == topic)
    return held.select(*MESSAGE.fieldNames())


def message_trades(messages: DataFrame) -> DataFrame:
    """Messages of the trades topic read back as trades."""
    sent = [f for f in TRADE.fields if f.name != "trade_ts"]
    derived = [
        T.StructField("totalVolume", VOLUME),
        T.StructField("timestamp", T.LongType()),
    ]
    return (
        messages.select(F.from_json("value", T.StructType(sent + derived)).alias("t"))
        .select("t.*")
        .withColumn("trade_ts", F.col("tradetime").try_cast("timestamp_ntz"))
    )


def scan_topic(messages: DataFrame) -> DataFrame:
    """Messages as ``key | value`` lines."""
    return messages.select(
        F.concat_ws(
            " | ",
            F.coalesce("key", F.lit("null")),
            F.coalesce("value", F.lit("null")),
        ).alias("line")
    )


def topic_counts(messages: DataFrame, partitions: int | None = None) -> DataFrame:
    """Messages per partition; with ``partitions`` given, empty ones are listed."""
    counted = messages.groupBy("partition").agg(F.count(F.lit(1)).alias("messages"))
    if partitions is None:
        return counted
    numbers = messages.sparkSession.range(partitions).select(
        F.col("id").cast("int").alias("partition")
    )
    return numbers.join(counted, "partition", "left").select(
        "partition", F.coalesce("messages", F.lit(0).cast("bigint")).alias("messages")
    )
