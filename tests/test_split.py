"""Responses read by byte ranges against the same files read as wholes."""

import json
import random
from collections import Counter

import pytest

from tickweave.plans import catalog
from tickweave.sources import envelope, split

HEADER = ["TRADENO", "TRADETIME", "SECID", "BOARDID", "PRICE", "QUANTITY", "VALUE", "BUYSELL"]
NAMES = ["SB]ER", 'GA"ZP', "a],[b", "\\x]", 'é]["', "plain"]


def rows(n, base):
    """Rows with brackets and quotes in their texts, null and short ones, nested cells."""
    pick = random.Random(base).choice
    for i in range(n):
        row = [base + i, f"2024-01-15 10:{i % 60:02d}:00", pick(NAMES), "TQBR", 1.5, i, 2.5, "B"]
        if i % 37 == 0:
            row = None
        elif i % 41 == 0:
            row = row[:4]
        elif i % 43 == 0:
            row[3] = [1, [2]]
        yield row


@pytest.fixture(scope="module")
def landing(tmp_path_factory):
    folder = tmp_path_factory.mktemp("landing")
    for i, indent in enumerate([None, 1]):
        body = {
            "marketdata": {"columns": ["X", "Y"], "data": [[1, 2], [3, 4]]},
            "trades": {"columns": HEADER, "data": list(rows(300, 1000 * i))},
            "securities": {"columns": ["SECID", "BOARDID"], "data": [["A", "B"], ["C]", "D"], ["E", "F"]]},
            "z": [[1], [2]],
        }
        (folder / f"{i}.json").write_text(json.dumps(body, indent=indent))
    whole = json.dumps({"trades": {"columns": HEADER, "data": list(rows(50, 9000))}})
    first = [[1, "2024-01-15 10:00:00", "A", "B", 1, 2, 3], [2, "2024-01-15 10:00:00", "A", "B", 1, 2, 3]]
    odd = {
        "cut": whole[:-5],
        "empty": "",
        "array": "[1]",
        "none": json.dumps({"trades": {"columns": HEADER, "data": []}}),
        "unnamed": json.dumps({"trades": {"data": first}}),
        "text": "no JSON",
    }
    for name, text in odd.items():
        (folder / f"{name}.json").write_text(text)
    return str(folder)


def decoded(responses):
    trades = envelope.decode_all_trades(responses).drop("file", "sent").collect()
    return Counter(map(tuple, trades)), Counter(map(tuple, envelope.decode_securities(responses).collect()))


@pytest.mark.parametrize("size, most", [("128m", 7), ("1500", 40)])
def test_pieces_give_the_rows_of_whole_files(spark, landing, size, most):
    """Ranges so short that texts and rows lie across them, and one for each file."""
    wanted = decoded(envelope.read_envelope(spark, landing))
    conf = {"spark.sql.files.maxPartitionBytes": size, "spark.sql.files.openCostInBytes": "1"}
    before = {key: spark.conf.get(key) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        responses = split.split_envelope(spark, landing, rows=most)
        assert decoded(responses) == wanted
        assert responses.filter("value LIKE '%\"data\":[[%'").count() > 600 / most / 2
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def test_a_stream_cannot_be_split(spark, landing):
    with pytest.raises(ValueError):
        envelope.read_envelope(spark, landing, layout="split", streaming=True)


def test_escapes_and_quotes():
    assert split._ends_inside('["a', False) and not split._ends_inside('b"', True)
    assert not split._ends_inside(r'["a\\"', False) and split._ends_inside(r'["a\"', False)


def test_each_long_response_is_a_file_of_its_own(spark, tmp_path):
    """Two responses that meet in one task: neither is lost behind the other."""
    events = spark.range(0, 50_100, 1, 1).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-15 10:00:00' AS ts", "id % 7 AS user_id",
        "'click' AS event_type", "1.5D AS value", "'{\"k\": 2}' AS props",
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        found = catalog.queries()["decode_split"](spark, str(tmp_path)).select("tradeno").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert sorted(r.tradeno for r in found) == list(range(50_100))
