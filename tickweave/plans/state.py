"""State tables of a collector, kept by generation and version below one folder.

Version ``n`` is what cycle ``n`` left behind. Each table is written in full,
into one of two slots by turns: cycle ``n`` reads the slot of ``n - 1`` and
replaces the one of ``n - 2``. Of the seen-set only the buckets change slots
that a cycle adds to. A cycle that is done again finds its input untouched, the
folder does not grow, and nothing has to be cleared away. Only
the cycle log and the quarantine grow, by one file per block of cycles and by
what could not be read.

Before a cycle works, its plan is written down: its window, and the generation.
Done again, it takes the window of its first attempt. A generation begins with
the first cycle, and again when cycle 0 comes back after later ones, as after a
lost cursor; its tables and messages stand apart from those of the ones before,
so a new start sends again and replaces nothing.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Collection
from contextlib import suppress
from dataclasses import dataclass, replace
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickweave.functions.scalars import ntz
from tickweave.operators.cursor import default_cursor
from tickweave.operators.dedup import bitmap_keys, seen_bitmaps
from tickweave.schemas import CURSOR, CYCLE, SEEN, SEEN_BITS

VERSIONED = {
    name: T.StructType([*table.fields, T.StructField("version", T.LongType())])
    for name, table in {"log": CYCLE}.items()
}
VERSIONED_CURSOR = T.StructType([T.StructField("version", T.LongType()), *CURSOR.fields])

PLAN = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("generation", T.StringType()),
        T.StructField("version", T.LongType()),
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.TimestampNTZType()),
        T.StructField("till", T.TimestampNTZType()),
        T.StructField("windows", T.LongType()),  # that it covers, one cycle each
        T.StructField("minutes", T.LongType()),  # of each, where there are several
    ]
)

# The seen-set lies in buckets by instrument; a cycle rewrites those it touches.
BUCKETS = 64
PLACES = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("slot", T.IntegerType()),
        T.StructField("version", T.LongType()),
        T.StructField("form", T.StringType()),  # rows, also where it is missing, or bits
    ]
)
FOLDERS = {"rows": "seen", "bits": "seen-bits"}

KEPT_ROWS = 500_000  # of a file: one row group is read by one task, however small the splits

CURSOR_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def one_row(spark: SparkSession, schema: T.StructType, values: dict) -> DataFrame:
    """A single row, as literals; fields without a value are NULL."""
    columns = []
    for field in schema.fields:
        value = values.get(field.name)
        literal = ntz(value) if isinstance(value, datetime) else F.lit(value)
        columns.append(literal.cast(field.dataType).alias(field.name))
    return spark.range(0, 1, 1, 1).select(*columns)


def _bucket() -> Column:
    return F.pmod(F.hash("secid"), F.lit(BUCKETS)).alias("bucket")


class Superseded(RuntimeError):
    """Another collector has claimed the state since."""


@dataclass(frozen=True)
class CollectorState:
    """The tables below ``root``: those of one ``generation``, or of the newest."""

    root: str
    log_block: int = 1000  # cycles per file of the closed log
    generation: str | None = None
    epoch: int | None = None  # of the claim; None is neither fenced nor fences

    def _epochs(self, spark: SparkSession):
        """The claims made so far, their folder, and its file system."""
        home = spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/owners")
        files = home.getFileSystem(spark._jsc.hadoopConfiguration())
        names = [s.getPath().getName() for s in files.listStatus(home)] if files.exists(home) else []
        return [int(name[len("epoch=") :]) for name in names if name.startswith("epoch=")], home, files

    def claim(self, spark: SparkSession) -> CollectorState:
        """This state for one collector alone: whoever claimed it before can begin and
        commit no cycle any more.

        A claim is a file that the file system creates for one of several at once; the
        others take the next number, and the highest holds. A cycle that the one before
        had begun is done again by its plan, as after any failure.
        """
        while True:
            epochs, home, files = self._epochs(spark)
            epoch = max(epochs, default=-1) + 1
            path = spark._jvm.org.apache.hadoop.fs.Path(home, f"epoch={epoch}")
            if files.createNewFile(path):
                return replace(self, epoch=epoch)

    def hold(self, spark: SparkSession) -> None:
        """Raise if another collector has claimed the state since."""
        if self.epoch is not None:
            newest = max(self._epochs(spark)[0], default=self.epoch)
            if newest > self.epoch:
                raise Superseded(f"{self.root} was claimed again: {newest} after {self.epoch}")

    def _home(self, spark: SparkSession) -> str:
        generation = self.generation
        if generation is None:
            generation = (self.read_plan(spark) or {}).get("generation")
        return f"{self.root}/generation={generation}" if generation else self.root

    def _slot(self, spark: SparkSession, name: str, version: int) -> str:
        return f"{self._home(spark)}/{name}/slot={version % 2}"

    def _cursors(self, spark: SparkSession) -> str:
        generation = self._home(spark)[len(self.root) :]
        return f"{self.root}/cursor{generation}"

    def _read(self, spark: SparkSession, name: str, version: int) -> DataFrame:
        held = spark.read.schema(VERSIONED[name]).parquet(self._slot(spark, name, version))
        if any(f"/version={version}/" not in file for file in held.inputFiles()):
            raise RuntimeError(f"{name} below {self.root} is not of cycle {version}")
        return held.drop("version")

    def _write(self, table: DataFrame, name: str, version: int) -> None:
        (
            table.withColumn("version", F.lit(version).cast("bigint"))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .partitionBy("version")
            .parquet(self._slot(table.sparkSession, name, version))
        )

    def _rows(self, spark: SparkSession, path: str, schema: T.StructType, may_lack=()) -> list:
        """The readable rows of a small table in two slots, so at most two."""
        unread = T.StructField("_unread", T.StringType())
        try:
            slots = (
                spark.read.schema(T.StructType([*schema.fields, unread]))
                .option("columnNameOfCorruptRecord", "_unread")
                .option("timestampNTZFormat", CURSOR_TIME)
                .json(path)
            )
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return []
        usable = F.col("_unread").isNull()
        for name in schema.fieldNames():
            if name not in may_lack:
                usable = usable & F.col(name).isNotNull()
        return [r.asDict() for r in slots.filter(usable).select(*schema.fieldNames()).collect()]

    def read_plan(self, spark: SparkSession) -> dict | None:
        """The plan of the newest cycle that was begun."""
        found = self._rows(spark, f"{self.root}/plan", PLAN, may_lack=("start", "till", "windows", "minutes"))
        return max(found, key=lambda row: row["seq"], default=None)

    def begin(
        self,
        spark: SparkSession,
        version: int,
        kind: str,
        start: datetime | None = None,
        till: datetime | None = None,
        windows: int = 1,
        minutes: int | None = None,
    ) -> tuple[CollectorState, dict]:
        """Write the plan of a cycle, or of several from ``version`` on, down, or find
        the one its first attempt left; return the state of its generation, and the
        plan."""
        self.hold(spark)
        last = self.read_plan(spark)
        fresh = last is None or (version == 0 and last["version"] > 0)
        if not fresh and last["version"] == version:
            return replace(self, generation=last["generation"]), last
        plan = {
            "seq": 0 if last is None else last["seq"] + 1,
            "generation": uuid.uuid4().hex if fresh else last["generation"],
            "version": version,
            "kind": kind,
            "start": start,
            "till": till,
            "windows": windows,
            "minutes": minutes,
        }
        (
            one_row(spark, PLAN, plan)
            .write.mode("overwrite")
            .option("timestampNTZFormat", CURSOR_TIME)
            .json(f"{self.root}/plan/slot={plan['seq'] % 2}")
        )
        return replace(self, generation=plan["generation"]), plan

    def _places(self, spark: SparkSession, version: int) -> dict[int, tuple[int, str]]:
        """In which slot, and which form, each bucket of the seen-set lies after cycle
        ``version``."""
        if version < 0:
            return {}
        held = spark.read.schema(PLACES).json(self._slot(spark, "seen-places", version))
        rows = held.collect()  # one row per bucket, and one for the version
        if any(row.version != version for row in rows) or not rows:
            raise RuntimeError(f"seen below {self.root} is not of cycle {version}")
        return {row.bucket: (row.slot, row.form or "rows") for row in rows if row.bucket >= 0}

    def read_seen(
        self,
        spark: SparkSession,
        version: int,
        buckets: Collection[int] | None = None,
        bits: bool = False,
    ) -> DataFrame:
        """The seen-set as cycle ``version`` left it, or some buckets of it, as rows or as
        bitmaps; before cycle 0 it is empty."""
        paths: dict[str, list[str]] = {form: [] for form in FOLDERS}
        for bucket, (slot, form) in self._places(spark, version).items():
            if buckets is None or bucket in buckets:
                place = f"{FOLDERS[form]}/bucket={bucket}/slot={slot}"
                paths[form].append(f"{self._home(spark)}/{place}")
        rows = spark.createDataFrame([], SEEN)
        if paths["rows"]:
            rows = spark.read.schema(SEEN).parquet(*paths["rows"])
        held = spark.createDataFrame([], SEEN_BITS)
        if paths["bits"]:
            held = spark.read.schema(SEEN_BITS).parquet(*paths["bits"])
        if bits:
            return held if not paths["rows"] else held.unionByName(seen_bitmaps(rows))
        return rows if not paths["bits"] else rows.unionByName(bitmap_keys(held))

    def buckets(self, keys: DataFrame) -> list[int]:
        """The buckets that hold the instruments of ``keys``."""
        return [row.bucket for row in keys.select(_bucket()).distinct().collect()]

    def write_seen(
        self,
        seen: DataFrame,
        version: int,
        buckets: Collection[int] | None = None,
        before: int | None = None,
    ) -> None:
        """Replace the seen-set, rows or bitmaps, or the named buckets of it and no others,
        as it was after cycle ``before``, the one before this version unless several are
        done at once.

        Each goes to the slot it does not lie in, so the set of the cycle before
        stays readable until this one is done.
        """
        spark = seen.sparkSession
        form = "bits" if "bits" in seen.columns else "rows"
        before = version - 1 if before is None else before
        places = {} if buckets is None else self._places(spark, before)
        if buckets is None:
            buckets = self.buckets(seen)
            with suppress(RuntimeError, AnalysisException):
                old = self._places(spark, before)
                places = {bucket: place for bucket, place in old.items() if bucket in buckets}
        places |= {bucket: (1 - places.get(bucket, (1, form))[0], form) for bucket in buckets}
        slots = F.array(*(F.lit(places.get(bucket, (0, form))[0]) for bucket in range(BUCKETS)))
        if buckets:
            (
                seen.withColumn("bucket", _bucket())
                .withColumn("slot", slots[F.col("bucket")])
                .hint("rebalance", "bucket")
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", "zstd")
                .partitionBy("bucket", "slot")
                .parquet(f"{self._home(spark)}/{FOLDERS[form]}")
            )
        rows = [(-1, 0, version, form)]
        rows += [(bucket, slot, version, kind) for bucket, (slot, kind) in places.items()]
        (
            spark.createDataFrame(rows, PLACES)
            .coalesce(1)
            .write.mode("overwrite")
            .json(self._slot(spark, "seen-places", version))
        )

    def write_accepted(self, fresh: DataFrame, version: int) -> DataFrame:
        """The new trades of a cycle written down, so they are computed once."""
        self.hold(fresh.sparkSession)
        return self._keep(fresh, "accepted", version)

    def stage_fetched(self, fetched: DataFrame, version: int) -> DataFrame:
        """The rows of a micro-batch written down, so they are decoded once."""
        return self._keep(fetched, "fetched", version)

    def _keep(self, table: DataFrame, name: str, version: int) -> DataFrame:
        path = self._slot(table.sparkSession, name, version)
        (
            table.write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .option("maxRecordsPerFile", KEPT_ROWS)
            .parquet(path)
        )
        return table.sparkSession.read.schema(table.schema).parquet(path)

    def write_quarantine(self, faults: DataFrame, version: int) -> None:
        """What a cycle could not read, kept for good."""
        path = f"{self._home(faults.sparkSession)}/quarantine/version={version}"
        faults.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)

    def read_quarantine(self, spark: SparkSession) -> DataFrame:
        """Unreadable responses and trades out of range: (version, file, fault, sent)."""
        schema = "file string, fault string, sent string, version bigint"
        try:
            path = f"{self._home(spark)}/quarantine"
            return spark.read.schema(schema).parquet(path)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return spark.createDataFrame([], schema)

    def read_cursor(self, spark: SparkSession, now: datetime) -> dict:
        """The newest readable cursor; the default one if there is none."""
        found = self._rows(spark, self._cursors(spark), VERSIONED_CURSOR)
        if found:
            return max(found, key=lambda row: row["version"])
        columns = [v.alias(name) for name, v in default_cursor(now).items()]
        return {"version": -1, **spark.range(1).select(*columns).first().asDict()}

    def write_cursor(self, spark: SparkSession, cursor: dict) -> None:
        self.hold(spark)
        path = f"{self._cursors(spark)}/slot={cursor['version'] % 2}"
        (
            one_row(spark, VERSIONED_CURSOR, cursor)
            .write.mode("overwrite")
            .option("timestampNTZFormat", CURSOR_TIME)
            .json(path)
        )

    def most_windows(self, version: int, windows: int) -> int:
        """How many cycles from ``version`` on can be committed as one: an odd number, as
        tables change slots with every commit, within one block of the log."""
        left = min(windows, self.log_block - version % self.log_block)
        return max(left - (left + 1) % 2, 1)

    def write_cycle(self, spark: SparkSession, *cycles: dict) -> None:
        """Add a cycle, or several of one commit, to the open block of the log; a full
        block is closed."""
        self.hold(spark)
        first, version = cycles[0]["cycle"], cycles[-1]["cycle"]
        block, place = divmod(first, self.log_block)
        rows = one_row(spark, CYCLE, cycles[0])
        if len(cycles) > 1:
            rows = spark.createDataFrame([[c.get(n) for n in CYCLE.names] for c in cycles], CYCLE)
        if place:
            rows = self._read(spark, "log", first - 1).unionByName(rows)
        if first == 0:  # the other slot may be left from before a lost cursor
            self._write(rows.limit(0), "log", 1)
        self._write(rows.coalesce(1), "log", version)
        if version % self.log_block == self.log_block - 1:
            closed = self._read(spark, "log", version).coalesce(1)
            closed.write.mode("overwrite").parquet(f"{self._home(spark)}/cycles/block={block}")

    def log_error(self, spark: SparkSession, cycle: dict) -> None:
        """Failed cycles are kept apart: the one done again has the same number."""
        failed = one_row(spark, CYCLE, {**cycle, "status": "error"})
        failed.write.mode("append").parquet(f"{self._home(spark)}/errors")

    def read_cycles(self, spark: SparkSession) -> DataFrame:
        """The cycle log, completed and failed cycles."""
        names, home = CYCLE.fieldNames(), self._home(spark)
        log = spark.createDataFrame([], CYCLE)
        for part in ("cycles", "errors"):
            try:
                held = spark.read.schema(CYCLE).parquet(f"{home}/{part}")
            except AnalysisException:
                continue
            log = log.unionByName(held.select(*names))
        try:
            held = spark.read.schema(VERSIONED["log"]).parquet(f"{home}/log")
        except AnalysisException:
            return log
        found = [re.search(r"/version=(\d+)/", f) for f in held.inputFiles()]
        newest = max((int(m[1]) for m in found if m), default=None)
        if newest is None or (newest + 1) % self.log_block == 0:
            return log
        return log.unionByName(held.filter(F.col("version") == newest).select(*names))
