"""Job settings and the session the jobs expect."""

from __future__ import annotations

from collections.abc import Iterator, Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

# Fixed values of the data model.
PAGE_SIZE = 5000  # rows per page of the source service
SEEN_CAP = 10_000  # trade numbers remembered per instrument
CATCH_UP_MINUTES = 5  # longest window one incremental cycle may cover
LATEST_LIMIT = 100  # default of the newest-N reports
TRIGGER_SECONDS = 3  # pause between two cycles

TRADES_TOPIC = "trades"
INSTRUMENTS_TOPIC = "instruments"
TOPIC_PARTITIONS = {TRADES_TOPIC: 3, INSTRUMENTS_TOPIC: 1}

# What a cycle does with responses and numbers it cannot read.
FAIL = "fail"
QUARANTINE = "quarantine"

ALL = "ALL"
SPECIFIC = "SPECIFIC"


@dataclass(frozen=True)
class Settings:
    enabled: bool = True
    mode: str = SPECIFIC
    symbols: list[str] = field(default_factory=list)
    page_size: int = PAGE_SIZE
    seen_cap: int | None = SEEN_CAP  # None keeps every trade number
    on_fault: str = FAIL
    catch_up_minutes: int = CATCH_UP_MINUTES
    run_id: str = "collector"

    def selection(self) -> list[str] | None:
        """Symbols to keep, or None when every instrument is wanted."""
        return None if self.mode == ALL else list(self.symbols)


# Skew handling splits one hot (secid, tradeno) key of the anti-join over several
# tasks. A repeated field name in a response counts where it stands last, instead
# of making the text unreadable. Streams keep their state in RocksDB, outside of
# the heap, and write down what changed and not the whole of it.
TUNING = {
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}


# Counting the keys of a stream's state takes one more lookup for each key written.
UNCOUNTED = {"spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false"}


@contextmanager
def defaults(spark: SparkSession, conf: Mapping[str, str]) -> Iterator[None]:
    """Settings that hold inside, but for those the session names itself."""
    ours = {key: value for key, value in conf.items() if spark.conf.get(key, None) is None}
    for key, value in ours.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key in ours:
            spark.conf.unset(key)


def tune(spark: SparkSession) -> SparkSession:
    """Give a session that is already there the settings the plans expect."""
    for key, value in TUNING.items():
        spark.conf.set(key, value)
    return spark


def session(app: str = "tickweave", **overrides: str) -> SparkSession:
    """A session of our own, for jobs and tests."""
    builder = SparkSession.builder.appName(app)
    conf = {"spark.sql.session.timeZone": "UTC", **TUNING, **overrides}
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
