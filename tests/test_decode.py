"""Column-block responses, case by case."""

import json
import os
import subprocess
import sys
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickweave.schemas import SECURITY, TRADE
from tickweave.sources import envelope

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
HEADER = ["TRADENO", "TRADETIME", "SECID", "BOARDID", "PRICE", "QUANTITY", "VALUE"]
ROW = [7, "2024-01-15 10:30:45", "SBER", "TQBR", 258.5, 100, 25850.25]


def trades_of(spark, *texts, trade_date=None):
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    envelopes = raw.select(F.try_parse_json("value").alias("envelope"))
    return envelope.decode_trades(envelopes, trade_date).collect()


def block(columns, *rows):
    return json.dumps({"trades": {"columns": columns, "data": list(rows)}})


def test_plain_row(spark):
    (row,) = trades_of(spark, block(HEADER, ROW))
    assert row.tradeno == 7 and row.secid == "SBER" and row.boardid == "TQBR"
    assert row.price == Decimal("258.5") and row.quantity == 100
    assert row.value == Decimal("25850.25")
    assert row.trade_ts == datetime(2024, 1, 15, 10, 30, 45)
    assert row.period is None and row.buysell is None and not row.is_defaulted


def test_schema(spark):
    raw = spark.createDataFrame([("{}",)], "value string")
    envelopes = raw.select(F.try_parse_json("value").alias("envelope"))
    trades = envelope.decode_trades(envelopes).drop("is_defaulted")
    assert [(f.name, f.dataType) for f in trades.schema] == [
        (f.name, f.dataType) for f in TRADE
    ]
    securities = envelope.decode_securities(envelopes)
    assert [(f.name, f.dataType) for f in securities.schema] == [
        (f.name, f.dataType) for f in SECURITY
    ]


def test_shuffled_header(spark):
    order = [6, 4, 2, 0, 5, 3, 1]
    (row,) = trades_of(
        spark, block([HEADER[i] for i in order], [ROW[i] for i in order])
    )
    assert (row.tradeno, row.secid, row.quantity) == (7, "SBER", 100)
    assert row.price == Decimal("258.5")


def test_missing_header_name_falls_back_to_its_place(spark):
    names = [n if n != "PRICE" else "OTHER" for n in HEADER]
    (row,) = trades_of(spark, block(names, ROW))
    assert row.price == Decimal("258.5")


def test_no_header_at_all(spark):
    (row,) = trades_of(spark, json.dumps({"trades": {"data": [ROW]}}))
    assert (row.tradeno, row.boardid) == (7, "TQBR")


def test_header_case_matters(spark):
    names = ["tradeno", *HEADER[1:], "TRADENO"]
    (row,) = trades_of(spark, block(names, [*ROW, 9]))
    assert row.tradeno == 9


def test_optional_column_by_name_only(spark):
    (row,) = trades_of(spark, block([*HEADER, "BUYSELL", "TS_OFFSET"], [*ROW, "B", 12]))
    assert (row.buysell, row.ts_offset) == ("B", 12)
    (row,) = trades_of(spark, block(HEADER, [*ROW, "x", "B"]))
    assert row.buysell is None


def test_repeated_header_name_counts_last(spark):
    (row,) = trades_of(spark, block([*HEADER, "PRICE"], [*ROW, 1.25]))
    assert row.price == Decimal("1.25")


def test_numbers_sent_as_text_become_zero(spark):
    broken = ["7", *ROW[1:4], "12.5", "3", "4.5"]
    (row,) = trades_of(spark, block(HEADER, broken))
    assert (row.tradeno, row.price, row.quantity, row.value) == (0, 0, 0, 0)
    assert row.is_defaulted


def test_null_cells_and_short_rows(spark):
    empty, short = trades_of(spark, block(HEADER, [None] * 7, [5]))
    assert empty.tradeno == 0 and empty.secid == "" and empty.tradetime == ""
    assert empty.price == 0 and empty.trade_ts is None and empty.is_defaulted
    assert short.tradeno == 5 and short.secid == "" and short.is_defaulted


@pytest.mark.parametrize("sent, kept", [(100.9, 100), (-1.7, -1), (3, 3)])
def test_fractions_are_cut_toward_zero(spark, sent, kept):
    (row,) = trades_of(spark, block(HEADER, [*ROW[:5], sent, 1]))
    assert row.quantity == kept


def test_texts_keep_other_kinds_readable(spark):
    (row,) = trades_of(spark, block(HEADER, [1, "t", 42, True, 1, 1, 1]))
    assert (row.secid, row.boardid) == ("42", "true")


def test_repeated_field_counts_last(spark):
    good = json.dumps({"columns": HEADER, "data": [ROW]})
    (row,) = trades_of(spark, f'{{"trades": {{"data": []}}, "trades": {good}}}')
    assert row.tradeno == 7


def test_null_row_is_dropped(spark):
    assert len(trades_of(spark, block(HEADER, None, ROW, None))) == 1


def test_block_with_a_row_that_is_no_array_gives_nothing(spark):
    assert trades_of(spark, block(HEADER, ROW, 5)) == []
    assert trades_of(spark, block(HEADER, ROW, {"a": 1})) == []


@pytest.mark.parametrize(
    "text",
    [
        "",
        "no json",
        "{}",
        '{"trades": null}',
        '{"trades": {}}',
        '{"trades": {"columns": ["TRADENO"]}}',
        '{"trades": {"columns": null, "data": [[1]]}}',
        '{"trades": {"columns": [], "data": null}}',
        '{"trades": {"columns": [], "data": []}}',
        '{"trades": 5}',
        '{"securities": {"columns": ["SECID"], "data": [["A"]]}}',
    ],
)
def test_no_rows(spark, text):
    assert trades_of(spark, text) == []


def test_unknown_fields_and_other_blocks_are_ignored(spark):
    text = json.dumps(
        {
            "trades": {"columns": HEADER, "data": [ROW], "metadata": {"a": 1}},
            "marketdata": {"columns": ["X"], "data": [[1]]},
            "extra": [1, 2],
        }
    )
    assert len(trades_of(spark, text)) == 1


def test_time_of_day_alone_needs_the_day(spark):
    row = [1, "10:30:45", "A", "B", 1, 1, 1]
    (bare,) = trades_of(spark, block(HEADER, row))
    assert bare.trade_ts is None and bare.tradetime == "10:30:45"
    (dated,) = trades_of(spark, block(HEADER, row), trade_date="2024-01-15")
    assert dated.trade_ts == datetime(2024, 1, 15, 10, 30, 45)
    assert dated.tradetime == "10:30:45"


def test_securities(spark):
    text = json.dumps(
        {
            "securities": {
                "columns": ["SECID", "BOARDID", "SHORTNAME", "PREVPRICE", "LOTSIZE"],
                "data": [["SBER", "TQBR", "Sber", 257.8, 10], [None, "X", None, "1", 2.9]],
            }
        }
    )
    raw = spark.createDataFrame([(text,)], "value string")
    envelopes = raw.select(F.try_parse_json("value").alias("envelope"))
    first, second = envelope.decode_securities(envelopes).collect()
    assert (first.secid, first.shortname, first.lotsize) == ("SBER", "Sber", 10)
    assert first.prevprice == Decimal("257.8") and first.facevalue is None
    assert (second.secid, second.shortname, second.lotsize) == ("", None, 2)
    assert second.prevprice is None


def test_one_response_per_file(spark, tmp_path):
    folder = tmp_path / "stock" / "shares" / "securities"
    folder.mkdir(parents=True)
    for i in range(3):
        body = {"securities": {"columns": ["SECID", "BOARDID"], "data": [[f"S{i}", "B"]]}}
        (folder / f"{i}.json").write_text(json.dumps(body, indent=2))
    found = envelope.list_securities(spark, str(tmp_path)).collect()
    assert sorted(r.secid for r in found) == ["S0", "S1", "S2"]


def test_streamed_responses(spark, tmp_path):
    folder = tmp_path / "landing"
    folder.mkdir()
    for i in range(3):
        rows = [[i * 10 + j, *ROW[1:]] for j in range(4)]
        (folder / f"{i}.json").write_text(block(HEADER, *rows))
    stream = envelope.read_envelope(spark, str(folder), streaming=True)
    query = (
        envelope.decode_trades(stream)
        .writeStream.format("memory")
        .queryName("decoded")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    found = sorted(r.tradeno for r in spark.table("decoded").collect())
    assert found == [i * 10 + j for i in range(3) for j in range(4)]


def test_texts_are_read_like_variants(spark):
    good = json.dumps({"columns": HEADER, "data": [ROW]})
    texts = [
        f'{{"trades": {{"data": []}}, "trades": {good}}}',
        block(HEADER, None, [*ROW[:4], "1.5", 2.9, 1e3], [None] * 7, [5]),
        block([*HEADER, "PRICE"], [*ROW, 1.25]),
        '{"trades": null}',
        '{"trades": {"columns": null, "data": [[1]]}}',
    ]
    raw = spark.createDataFrame([(t,) for t in texts], "value string")
    envelopes = raw.select(F.try_parse_json("value").alias("envelope"))
    found = envelope.decode_trades(raw).collect()
    assert len(found) == 5 and found == envelope.decode_trades(envelopes).collect()


def test_unreadable_responses_are_named(spark, tmp_path):
    whole = block(HEADER, ROW)
    bad = {
        "cut.json": whole[:-9],
        "empty.json": "",
        "text.json": "no json",
        "list.json": "[1, 2]",
        "row.json": block(HEADER, ROW, 5),
        "shape.json": '{"trades": 5}',
    }
    fine = {"good.json": whole, "none.json": "{}", "other.json": '{"securities": {"data": [["A"]]}}'}
    for name, text in {**bad, **fine}.items():
        (tmp_path / name).write_text(text)
    responses = envelope.read_envelope(spark, str(tmp_path))
    named = {r.file.rsplit("/", 1)[1]: r.fault for r in envelope.unreadable_responses(responses).collect()}
    assert set(named) == set(bad) - {"empty.json"} or set(named) == set(bad)
    assert named["cut.json"] == "broken JSON or block" and named["text.json"] == "no JSON object"
    assert envelope.decode_trades(responses).count() == 1
    report = envelope.decode_report(envelope.decode_all_trades(responses)).first()
    assert (report.n_rows, report.unreadable, report.out_of_range) == (1, len(named), 0)


@pytest.mark.parametrize("at, sent", [(4, 1234567890123.5), (4, 1e-7), (6, 1e30), (0, 2**70), (5, 1e25)])
def test_no_number_that_was_sent_becomes_zero(spark, at, sent):
    text = block(HEADER, [*ROW[:at], sent, *ROW[at + 1 :]], ROW)
    raw = spark.createDataFrame([(text,)], "value string")
    assert [r.tradeno for r in envelope.decode_trades(raw).collect()] == [7]
    (out,) = envelope.decode_all_trades(raw).filter("fault is not null").collect()
    assert out.fault == "number out of range" and json.loads(out.sent)[2] == "SBER"
    zero = block(HEADER, [*ROW[:at], 0, *ROW[at + 1 :]])
    assert len(trades_of(spark, zero)) == 1


LONG = """
import sys
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from tickweave.sources import envelope
spark = (
    SparkSession.builder.master("local[2]").config("spark.driver.memory", "6g")
    .config("spark.ui.enabled", "false").getOrCreate()
)
responses = envelope.read_envelope(spark, sys.argv[1])
trades = envelope.decode_trades(responses)
print(trades.agg(F.countDistinct("tradeno")).first()[0], envelope.unreadable_responses(responses).count())
"""


def test_a_long_response_keeps_all_rows(tmp_path):
    """Far beyond what one VARIANT holds; in a process with the memory for it."""
    n = 2_700_000
    (tmp_path / "landing").mkdir()
    path = tmp_path / "landing" / "long.json"
    with path.open("w") as file:
        file.write(json.dumps({"trades": {"columns": HEADER}})[:-2] + ', "data": [')
        file.writelines(
            f'{"," if i else ""}[{i},"2024-01-15 10:30:45","S{i % 7}","B",1.5,2,3.0]' for i in range(n)
        )
        file.write("]}}")
    assert path.stat().st_size > 128 << 20
    env = os.environ | {"PYTHONPATH": ROOT}
    run = subprocess.run(
        [sys.executable, "-c", LONG, str(path.parent)], env=env, capture_output=True, text=True, timeout=600
    )
    assert run.stdout.split() == [str(n), "0"], run.stderr[-2000:]
