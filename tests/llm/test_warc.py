"""Archives: exact round trip, any split size, odd rows, stray magic."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tickweave.llm import warc
from tickweave.llm.common import scratch, table


@pytest.mark.parametrize("split", [997, 20_000, warc.SPLIT])
def test_ranges_give_each_record_once(spark, sf_dir, split):
    pages = table(spark, sf_dir, "pages").filter("page_id < 40").repartition(3)
    folder = scratch(spark, "warc")
    read = warc.read_warc(warc.write_warc(pages, folder), folder, split).collect()
    rows = {f"<urn:row:{r.page_id}>": r for r in pages.collect()}
    assert sorted(r.record_id for r in read) == sorted(rows)
    for r in read:
        assert bytes(r.payload).decode() == rows[r.record_id].html and r.target_uri == rows[r.record_id].url


def test_odd_rows(spark):
    rng = random.Random(1)
    noise = "".join(chr(rng.randint(1, 0x2FFF)) for _ in range(400_000))
    long = "x" * 100
    rows = [(5, "u", long), (3, None, long), (9, "a\r\nb", long), (3, "", long), (None, "n", long), (None, "n", noise)]
    rows += [(20, "u", "y" * 99), (21, "u", "y" * 99), (22, "u", ""), (23, "u", None), (24, "u", noise), (None, "u", "z" * 200)]
    rows += [(30, "u", "\x1f\x0b\x08" * 50), (31, "u", "\r\n\r\nWARC/1.1\r\n" * 20)]
    pages = spark.createDataFrame([(*r, "k") for r in rows], "page_id long, url string, html string, digest string")
    got = sorted((tuple(r) for r in warc.archived(pages).collect()), key=str)
    wanted = []
    for key, _, html in rows:
        body = (html or "").encode()
        same = [k for k, _, h in rows if (h or "") == (html or "") and k is not None]
        first = min(same) if same and len(body) >= 100 else None
        revisit = first is not None and key != first
        wanted.append(
            (key, len(body), hashlib.sha256(body).hexdigest(), "revisit" if revisit else "response", first if revisit else None)
        )
    assert got == sorted(wanted, key=str)
    assert warc.archived(pages.limit(0)).collect() == []


def test_magic_that_starts_no_record(tmp_path):
    import io

    member = warc.zlib.compressobj(0, warc.zlib.DEFLATED, 31)
    inner = warc.MAGIC + b"no member" + warc.MAGIC
    body = warc._record(1, "u", None, "d", inner, len(inner))
    data = b"junk" + warc.MAGIC + member.compress(body) + member.flush()
    for cut in range(0, len(data), 7):
        found = [
            warc._parsed(r)["payload"]
            for lo, hi in ((0, cut), (cut, len(data)))
            for _, r in warc._records(io.BytesIO(data), len(data), lo, hi)
        ]
        assert found == [inner]


def test_hot_payload_is_spread(spark):
    pages = spark.range(3000).select(
        F.col("id").alias("page_id"), F.lit("u").alias("url"), F.when(F.col("id") % 3 == 0, F.repeat(F.lit("ab"), 100)).otherwise(F.concat(F.lit("p" * 100), F.col("id"))).alias("html")
    )
    rows = warc.archived(pages).groupBy("record_type", "refers_to").count().collect()
    assert {(r.record_type, r.refers_to): r["count"] for r in rows} == {("response", None): 2001, ("revisit", 0): 999}
