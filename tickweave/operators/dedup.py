"""Duplicates: the seen-set and what is done with it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.schemas import SORT_KEY, TRADE_KEY
from tickweave.settings import SEEN_CAP
from tickweave.storage import stage

CELL_BITS = 15  # a bitmap of 4 kB holds so many bits' worth of numbers
BINS = 1024  # of a histogram of cells


def filter_new_trades(trades: DataFrame, seen: DataFrame) -> DataFrame:
    """Trades whose key is not in ``seen``; duplicates inside the batch stay.

    No broadcast hint: the seen-set grows with the number of instruments, so
    Spark compares its actual size with the broadcast threshold. Beyond that
    it is a sort-merge join, whose hot keys adaptive execution splits. ``seen`` may
    also be bitmaps.
    """
    if "bits" in seen.columns:
        return filter_unseen(trades, seen)
    known = seen.select(*SORT_KEY)
    return trades.join(known, SORT_KEY, "left_anti").select(*trades.columns)


def dedup_trades(trades: DataFrame) -> DataFrame:
    """One row per (secid, tradeno): the earliest, ties by the other columns.

    ``row_number() = 1`` is planned with a group limit before the shuffle, so
    each task sends at most one row of a key that repeats without end.
    """
    rest = [c for c in trades.columns if c not in (*TRADE_KEY, "trade_ts")]
    first = Window.partitionBy(*SORT_KEY).orderBy(
        F.col("trade_ts").asc_nulls_last(), *(F.col(c).asc_nulls_last() for c in rest)
    )
    return (
        trades.withColumn("_copy", F.row_number().over(first))
        .filter(F.col("_copy") == 1)
        .drop("_copy")
    )


def cell() -> Column:
    """Which run of 32,768 consecutive trade numbers a number lies in."""
    return F.shiftright("tradeno", CELL_BITS)


def place() -> Column:
    """Where in its cell a number lies."""
    return F.col("tradeno").bitwiseAND((1 << CELL_BITS) - 1).cast("int")


def _number(of_cell: Column, at: Column) -> Column:
    return (F.shiftleft(of_cell, CELL_BITS) + at).alias("tradeno")


def _cells(keys: DataFrame) -> DataFrame:
    """(secid, cell, places): the distinct numbers of each instrument, cell by cell.

    Places are gathered before the shuffle, so a number that repeats without end leaves
    each task once, and no row holds more than a cell has numbers.
    """
    known = keys.filter(F.col("tradeno").isNotNull())
    placed = known.select("secid", cell().alias("cell"), place().alias("place"))
    return placed.groupBy("secid", "cell").agg(F.collect_set("place").alias("places"))


def _narrowed(cells: DataFrame, spans: DataFrame) -> DataFrame:
    """The spans of cells, one per instrument, narrowed to the part in which the number
    wanted lies: a histogram of the span, and the bin that ``need`` is reached in when
    they are counted from the top."""
    width = F.expr(f"(hi - lo) div {BINS} + 1")
    inside = cells.join(spans.withColumn("width", width), "secid").filter("cell BETWEEN lo AND hi")
    counts = inside.groupBy("secid", "lo", "hi", "need", "width", F.expr("(cell - lo) div width").alias("bin")).agg(
        F.sum("n").alias("n")
    )
    bins = F.sort_array(F.collect_list(F.struct("bin", "n")), asc=False)  # as many as BINS
    start = F.struct(F.lit(None).cast("bigint").alias("bin"), F.col("need"))

    def passed(found: Column, bin: Column) -> Column:
        here = F.when(found["bin"].isNull() & (bin["n"] >= found["need"]), bin["bin"])
        over = found["bin"].isNull() & (bin["n"] < found["need"])
        return F.struct(
            F.coalesce(found["bin"], here).alias("bin"),
            (found["need"] - F.when(over, bin["n"]).otherwise(0)).alias("need"),
        )

    per_span = counts.groupBy("secid", "lo", "hi", "need", "width").agg(bins.alias("bins"))
    found = per_span.withColumn("found", F.aggregate("bins", start, passed))
    first = F.col("lo") + F.col("found.bin") * F.col("width")
    return found.select(
        "secid",
        first.alias("lo"),
        F.least(first + F.col("width") - 1, F.col("hi")).alias("hi"),
        F.col("found.need").alias("need"),
    )


def bounded_seen_set(keys: DataFrame, cap: int | None = SEEN_CAP) -> DataFrame:
    """The ``cap`` largest distinct trade numbers of each instrument; all of them
    without a cap.

    The same set as adding numbers one by one and evicting the smallest above
    the cap, in any order. A few instruments hold most trades, so no task orders
    the numbers of an instrument: they are counted by cells of 32,768, and where an
    instrument has more than the cap, histograms of its cells, each over the bin that
    the one before ended in, find the cell in which the cap is reached. What is above
    it stays, and of that cell its largest numbers. Numbers without a value are left out.
    """
    secid = F.coalesce("secid", F.lit("")).alias("secid")  # a missing instrument is "" in the data model
    keys = keys.select(secid, "tradeno").filter(F.col("tradeno").isNotNull())
    if cap is None:
        return keys.distinct()
    cells = stage(_cells(keys).withColumn("n", F.size("places").cast("bigint")), "seen-cells")
    ends = [F.min("cell").alias("lo"), F.max("cell").alias("hi"), F.sum("n").alias("held")]
    spans = cells.groupBy("secid").agg(*ends).filter(F.col("held") > cap)
    spans = stage(spans.select("secid", "lo", "hi", F.lit(cap).cast("bigint").alias("need")), "seen-spans")
    while (widest := spans.agg(F.max(F.col("hi") - F.col("lo"))).first()[0]) is not None:
        if widest == 0:
            break
        spans = stage(_narrowed(cells, spans), "seen-spans")
    edges = spans.select("secid", F.col("lo").alias("edge"), "need")
    kept = cells.join(edges, "secid", "left").filter(F.col("edge").isNull() | (F.col("cell") >= F.col("edge")))
    largest = F.slice(F.sort_array("places", asc=False), 1, F.col("need").cast("int"))
    places = F.when(F.col("cell") == F.col("edge"), largest).otherwise(F.col("places"))
    each = kept.select("secid", "cell", F.explode(places).alias("place"))
    return each.select("secid", _number(F.col("cell"), F.col("place")))


def mark_batch(
    seen: DataFrame, batch: DataFrame, cap: int | None = SEEN_CAP
) -> DataFrame:
    """The seen-set, rows or bitmaps, after a whole batch was added to it. Bitmaps have
    no cap."""
    if "bits" in seen.columns:
        return mark_bitmaps(seen, batch)
    return bounded_seen_set(
        seen.select(*TRADE_KEY).unionByName(batch.select(*TRADE_KEY)), cap
    )


def seen_counts(seen: DataFrame) -> DataFrame:
    """Trade numbers held per instrument; of bitmaps from their counts of bits."""
    if "bits" in seen.columns:
        return bitmap_counts(seen)
    return seen.groupBy("secid").agg(F.count(F.lit(1)).alias("held"))


def seen_bitmaps(keys: DataFrame) -> DataFrame:
    """Every trade number of each instrument, without a cap, as (secid, cell, bits): one
    row and a bitmap of 4 kB for each cell of 32,768 numbers that any lies in.

    For numbers that lie close together, as an exchange gives them; numbers far apart take
    a bitmap each, which only compression of the stored table makes small.
    """
    each = _cells(keys).select("secid", "cell", F.explode("places").alias("place"))
    return each.groupBy("secid", "cell").agg(F.bitmap_construct_agg("place").alias("bits"))


def mark_bitmaps(seen: DataFrame, batch: DataFrame) -> DataFrame:
    """The bitmaps after a batch of trades was added; only bitmaps are moved for the
    seen ones."""
    both = seen.select("secid", "cell", "bits").unionByName(seen_bitmaps(batch))
    return both.groupBy("secid", "cell").agg(F.bitmap_or_agg("bits").alias("bits"))


def _bit(bits: Column, at: Column) -> Column:
    """Whether a bit is set; the first bit of a byte is its lowest."""
    byte = F.substring(bits, F.shiftright(at, 3) + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.call_function("shiftright", value, at.bitwiseAND(7)).bitwiseAND(1) == 1


def filter_unseen(trades: DataFrame, seen: DataFrame) -> DataFrame:
    """The trades whose bit is not set in any of the bitmaps.

    A bitmap is joined by instrument and cell, so what is moved of the seen-set is its
    bitmaps and not its numbers, and cells spread a busy instrument over tasks; a cell of
    the trades that is hot all the same is split by adaptive execution.
    """
    held = seen.select(*(F.col(c).alias(f"_seen_{c}") for c in ("secid", "cell", "bits")))
    at = (F.col("secid") == F.col("_seen_secid")) & (cell() == F.col("_seen_cell"))
    known = F.coalesce(_bit(F.col("_seen_bits"), place()), F.lit(False))
    return trades.join(held, at, "left").filter(~known).select(*trades.columns)


def bitmap_counts(seen: DataFrame) -> DataFrame:
    """Trade numbers held per instrument, from the bitmaps alone."""
    return seen.groupBy("secid").agg(F.sum(F.bitmap_count("bits")).alias("held"))


def bitmap_keys(seen: DataFrame) -> DataFrame:
    """The numbers of bitmaps as rows."""
    bytes_ = seen.select("secid", "cell", "bits", F.explode(F.sequence(F.lit(0), F.lit((1 << CELL_BITS - 3) - 1))).alias("_byte"))
    some = bytes_.filter(F.substring("bits", F.col("_byte") + 1, F.lit(1)) != F.lit(b"\0"))
    bits = some.select("secid", "cell", "bits", F.explode(F.sequence(F.col("_byte") * 8, F.col("_byte") * 8 + 7)).alias("place"))
    return bits.filter(_bit(F.col("bits"), F.col("place"))).select("secid", _number(F.col("cell"), F.col("place")))
