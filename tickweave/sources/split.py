"""Long responses read by byte ranges, as many short ones of the same rows.

A response is cut at closing brackets by the text source, which splits files: each task
owns the pieces that start in its byte range. A piece that ends inside a text goes on in
the next. Pieces that are one more flat row of some block are gathered, so many to a
response; all others, in order, are the skeleton of the file: the response without these
rows, short enough to be read as a whole. It has the header, and says to which block the
rows after each of its pieces belong.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tickweave.settings import PAGE_SIZE
from tickweave.storage import stage

ROW = re.compile(r'\s*,\s*(\[(?:[^\[\]{}"]|"(?:[^"\\]|\\.)*")*)\Z', re.DOTALL)
ESCAPED = re.compile(r"\\.", re.DOTALL)
CHARS = 1 << 20  # of a short response, after which a new one begins
PIECES = "file string, block long, seq long, kind string, owner long, text string"


def _ends_inside(text: str, inside: bool) -> bool:
    """Whether a text literal is open after a piece. No escape goes across a bracket."""
    return inside ^ bool(ESCAPED.sub("", text).count('"') % 2)


def _sorted_out(inside_starts: set, rows: int):
    """Pieces in reading order as ``rows`` (some rows of one block), ``bone`` (a piece of
    the skeleton), ``head`` (the end of a literal that began before the byte range) and
    ``open`` (what has no end in it)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, seq, owner = None, 0, None
        glued: list[str] = []
        inside = head = False
        some: list[str] = []
        chars = 0
        out: list[tuple] = []

        def put(kind: str, text: str) -> None:
            nonlocal seq
            out.append((*place, seq, kind, owner, text))
            seq += 1

        def flush() -> None:
            nonlocal chars
            if some:
                put("rows", ",".join(some))
                some.clear()
                chars = 0

        def finish() -> None:
            flush()
            if glued:
                put("head" if head else "open" if inside else "bone", "]".join(glued))
                glued.clear()

        def packed() -> pa.RecordBatch:
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string())
            columns = list(zip(*out)) or [()] * 6
            out.clear()
            names = ["file", "block", "seq", "kind", "owner", "text"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        for batch in batches:
            for file, block, text in zip(*(batch.column(c).to_pylist() for c in ("file", "block", "value"))):
                if (file, block) != place:
                    if place:
                        finish()
                    place, seq, owner = (file, block), 0, None
                    inside = head = (file, block) in inside_starts
                inside = _ends_inside(text, inside)
                glued.append(text)
                if inside:
                    continue
                whole = "]".join(glued)
                glued.clear()
                if head:
                    head = False
                    put("head", whole)
                elif row := ROW.match(whole):
                    some.append(row[1] + "]")
                    chars += len(whole)
                    if len(some) >= rows or chars > CHARS:
                        flush()
                else:
                    flush()
                    owner = seq
                    put("bone", whole)
            yield packed()
        if place:
            finish()
        yield packed()

    return work


def split_envelope(spark: SparkSession, path: str, rows: int = PAGE_SIZE) -> DataFrame:
    """(file, value): the responses of ``path``, each as several of up to ``rows`` rows.

    They decode to the same rows as the files do as wholes. A file whose skeleton cannot
    be read gives that alone, so its rows are lost to a fault as a whole, as they would
    be; a fault in single rows is that of the short response they are in.
    """
    raw = spark.read.option("lineSep", "]").text(path)
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block")]
    pieces = raw.select(*place, "value")
    quotes = F.regexp_count(F.regexp_replace("value", r"(?s)\\.", ""), F.lit('"'))
    parts = pieces.groupBy("file", "block").agg(F.sum(quotes).alias("quotes"))  # one row per byte range
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    odd = parts.withColumn("before", F.sum("quotes").over(earlier)).filter("before % 2 = 1")
    starts = {(r.file, r.block) for r in odd.select("file", "block").collect()}  # ranges that cut a text with brackets
    found = stage(pieces.mapInArrow(_sorted_out(starts, rows), PIECES), "pieces")
    # What was cut by a byte range is put together; the parts lie one after another.
    cut = found.filter("kind IN ('open', 'head')")
    order = Window.partitionBy("file").orderBy("block", "seq")
    begun = cut.withColumn("part", F.count_if(F.col("kind") == "open").over(order))
    joined = begun.groupBy("file", "part").agg(
        F.min("block").alias("block"),
        F.min_by("seq", "block").alias("seq"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "text"))), lambda p: p["text"]), "]").alias("text"),
    )
    bones = found.filter("kind = 'bone'").select("file", "block", "seq", "text")
    bones = stage(bones.unionByName(joined.select("file", "block", "seq", "text")), "bones")
    # The rows after a piece of the skeleton: those up to the next one, in any byte range.
    last = bones.groupBy("file", "block").agg(F.max("seq").alias("last"))
    runs = found.filter("kind = 'rows'")
    ranges = found.select("file", "block").distinct().join(last, ["file", "block"], "left")
    before = F.last(F.when(F.col("last").isNotNull(), F.struct("block", "last")), ignorenulls=True).over(earlier)
    ranges = ranges.select("file", "block", before.alias("before"))
    own = F.when(F.col("owner").isNotNull(), F.struct("block", F.col("owner").alias("last")))
    owned = runs.join(ranges, ["file", "block"], "left").withColumn("after", F.coalesce(own, "before"))
    owned = stage(owned.select("file", "after", "text"), "row-runs")
    owners = owned.select("file", F.col("after.block").alias("block"), F.col("after.last").alias("seq")).distinct()
    sign = f"rows-after-{uuid.uuid4().hex}-"  # in no response
    mark = F.concat(F.lit(f',["{sign}'), "block", F.lit("-"), "seq", F.lit('"]'))
    marked = bones.join(owners.withColumn("mark", mark), ["file", "block", "seq"], "left")
    parts = F.sort_array(F.collect_list(F.struct("block", "seq", "text", F.coalesce("mark", F.lit("")).alias("mark"))))

    def told(with_marks: bool):
        closed = F.transform(parts, lambda p: F.concat(p["text"], F.lit("]"), p["mark"] if with_marks else F.lit("")))
        text = F.array_join(closed, "")
        return text if with_marks else F.substring(text, F.lit(1), F.length(text) - 1)

    # The last piece of a file ends without a bracket, and owns no rows.
    skeletons = stage(marked.groupBy("file").agg(told(False).alias("value"), told(True).alias("told")), "skeletons")
    sound = skeletons.filter(F.try_parse_json("value").isNotNull())
    blocks = sound.select(
        "file", F.explode(F.from_json(F.expr("substring(told, 1, length(told) - 1)"), "map<string, string>")).alias("name", "body")
    )
    columns = F.get_json_object("body", "$.columns")
    where = F.regexp_extract_all("body", F.lit(f"{sign}([0-9]+-[0-9]+)"), F.lit(1))
    named = blocks.select("file", "name", columns.alias("columns"), F.explode(where).alias("after"))
    short = owned.withColumn("after", F.concat_ws("-", "after.block", "after.last")).join(named, ["file", "after"])
    header = F.when(F.col("columns").isNotNull(), F.concat(F.lit('"columns":'), "columns", F.lit(","))).otherwise("")
    value = F.concat(F.lit('{"'), "name", F.lit('":{'), header, F.lit('"data":['), "text", F.lit("]}}"))
    empty = spark.read.format("binaryFile").load(path).filter("length = 0")
    return (
        skeletons.select("file", "value")
        .unionByName(short.select("file", value.alias("value")))
        .unionByName(empty.select(F.col("path").alias("file"), F.lit("").alias("value")))
    )
