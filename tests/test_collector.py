"""The collector as a job and as a stream: results, repeats, broken runs."""

import json
import random
from collections import Counter
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tickweave import job
from tickweave.operators import cycles
from tickweave.plans import catalog, loads, views
from tickweave.plans import state as state_module
from tickweave.plans.state import CollectorState, Superseded
from tickweave.settings import ALL, SPECIFIC, TRADES_TOPIC, Settings
from tickweave.sinks.messages import (
    FileSink,
    security_messages,
    sink_securities,
    sink_trades,
    trade_messages,
)
from tickweave.sources import topic
from tickweave.streaming import collector

OPEN = datetime(2024, 1, 15)
SCHEMA = """tradeno bigint, tradetime string, secid string, boardid string,
    price decimal(18,6), quantity bigint, value decimal(24,6), period string,
    tradingsession string, buysell string, systime string, ts_offset bigint,
    trade_ts timestamp_ntz"""


def trade(secid, tradeno, at, price="1.5", quantity=2):
    moment = OPEN + timedelta(seconds=at)
    return (
        tradeno,
        str(moment),
        secid,
        "TQBR",
        Decimal(price),
        quantity,
        Decimal(price) * quantity,
        None,
        None,
        "B",
        None,
        None,
        moment,
    )


def day_of_trades(seed=0, n=600):
    rng = random.Random(seed)
    rows = [
        trade(rng.choice(["SBER", "SBER", "GAZP", "LKOH"]), i // 2, rng.randrange(0, 5400))
        for i in range(n)
    ]
    return rows + [trade("SBER", 10_000 + m, m * 300) for m in range(18)]


class Clock:
    def __init__(self, at):
        self.now = OPEN + timedelta(seconds=at)

    def __call__(self):
        return self.now


def plain_collector(rows, symbols, ticks, cap):
    """One pass of the collector per tick, over plain lists."""
    start, initial, held, cycles_seen = OPEN, True, {}, []
    for tick in ticks:
        now = OPEN + timedelta(seconds=tick)
        till = now if initial else cycles.next_till(start, now)
        inside = [
            r
            for r in rows
            if start <= r[12] <= till and (symbols is None or r[2] in symbols)
        ]
        keys = {(r[2], r[0]) for r in inside}
        if not initial:
            keys = {k for k in keys if k[1] not in held.get(k[0], set())}
        for secid, tradeno in keys:
            numbers = held.setdefault(secid, set())
            numbers.add(tradeno)
        for secid in held:
            held[secid] = set(sorted(held[secid])[-cap:])
        cycles_seen.append((till, len(inside), keys))
        start, initial = till, False
    return cycles_seen, held


@pytest.mark.parametrize("symbols", [None, ["SBER", "LKOH"]])
def test_cycles_match_a_plain_collector(spark, tmp_path, symbols):
    rows = day_of_trades()
    trades = spark.createDataFrame(rows, SCHEMA)
    state = CollectorState(str(tmp_path / "state"))
    sink = FileSink(str(tmp_path / "topic"))
    job = Settings(
        mode=ALL if symbols is None else SPECIFIC,
        symbols=symbols or [],
        page_size=50,
        seen_cap=40,
    )
    ticks = [1800, 1803, 2400, 2400, 2401]
    wanted, held = plain_collector(rows, symbols, ticks, 40)
    everything = Counter()
    for number, (tick, (till, fetched, keys)) in enumerate(zip(ticks, wanted)):
        row = loads.run_cycle(trades, state, sink, job, Clock(tick))
        assert (row["till"], row["collected"]) == (till, len(keys))
        assert row["duplicates"] == fetched - len(keys)
        assert row["api_calls"] == fetched // 50 + 1
        everything.update(f"{s}:{n}" for s, n in keys)
    sent = topic.read_topic(spark, sink.path, TRADES_TOPIC)
    assert Counter(r.key for r in sent.select("key").collect()) == everything
    kept = {}
    for r in state.read_seen(spark, len(ticks) - 1).collect():
        kept.setdefault(r.secid, set()).add(r.tradeno)
    assert kept == {s: n for s, n in held.items() if n}
    cursor = state.read_cursor(spark, OPEN)
    assert cursor["last_trade_time"] == wanted[-1][0]
    assert cursor["total_trades_collected"] == sum(len(k) for _, _, k in wanted)
    totals = cycles.metrics_totals(state.read_cycles(spark)).first()
    assert totals.total_trades_collected == cursor["total_trades_collected"]
    assert totals.total_cycles_completed == len(ticks)


def test_a_broken_cycle_is_done_again(spark, tmp_path):
    trades = spark.createDataFrame(day_of_trades(1), SCHEMA)
    state = CollectorState(str(tmp_path / "state"))
    good = FileSink(str(tmp_path / "topic"))
    job = Settings(mode=ALL, seen_cap=10_000)

    class Broken(FileSink):
        def write(self, messages, batch_id=0):
            super().write(messages, batch_id)
            raise OSError("lost")

    loads.run_cycle(trades, state, good, job, Clock(1800))
    before = state.read_cursor(spark, OPEN)
    with pytest.raises(OSError):
        loads.run_cycle(trades, state, Broken(good.path), job, Clock(1900))
    assert state.read_cursor(spark, OPEN) == before
    loads.run_cycle(trades, state, good, job, Clock(1900))
    keys = [r.key for r in topic.read_topic(spark, good.path, TRADES_TOPIC).collect()]
    totals = cycles.metrics_totals(state.read_cycles(spark)).first()
    assert len(keys) == len(set(keys)) == totals.total_trades_collected
    early = trades.filter(F.col("trade_ts") <= F.lit(str(OPEN + timedelta(seconds=1900))))
    assert len(keys) == early.select("secid", "tradeno").distinct().count()
    (errors,) = cycles.error_count(state.read_cycles(spark)).collect()
    assert errors.total_errors == 1


@pytest.mark.parametrize("block", [1, 3, 1000])
def test_log_in_blocks(spark, tmp_path, block):
    state = CollectorState(str(tmp_path), log_block=block)
    assert state.read_cycles(spark).count() == 0
    for n in [0, 1, 2, 2, 3, 4, 5, 5, 6]:  # some cycles are done again
        state.write_cycle(spark, {"cycle": n, "status": "ok", "collected": n})
        rows = state.read_cycles(spark).select("cycle", "collected").collect()
        assert sorted(tuple(r) for r in rows) == [(i, i) for i in range(n + 1)]
    state.log_error(spark, {"cycle": 7})
    assert state.read_cycles(spark).filter("status = 'error'").count() == 1
    closed = list((tmp_path / "cycles").glob("block=*")) if block < 1000 else []
    assert len(closed) == {1: 7, 3: 2, 1000: 0}[block]


def test_cursor_keeps_microseconds(spark, tmp_path):
    state = CollectorState(str(tmp_path))
    cursor = {
        "version": 3,
        "last_trade_time": datetime(2024, 3, 10, 2, 30, 0, 123_456),
        "initial_load_complete": True,
        "total_trades_collected": 5,
        "total_cycles_completed": 2,
        "last_update_time": datetime(2024, 3, 10, 2, 30, 1, 1),
    }
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        state.write_cursor(spark, cursor)
        assert state.read_cursor(spark, OPEN) == cursor
        state.write_cursor(spark, {**cursor, "version": 4})
        assert state.read_cursor(spark, OPEN)["version"] == 4
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_cycles_without_trades_move_on(spark, tmp_path):
    state = CollectorState(str(tmp_path / "state"))
    sink = FileSink(str(tmp_path / "topic"))
    none = spark.createDataFrame([], SCHEMA)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        for tick in (60, 120, 180):
            row = loads.run_cycle(none, state, sink, Settings(mode=ALL), Clock(tick))
            assert (row["collected"], row["api_calls"]) == (0, 1)
        some = spark.createDataFrame([trade("A", 1, 200)], SCHEMA)
        for tick, count in ((240, 1), (300, 0), (360, 0)):
            row = loads.run_cycle(some, state, sink, Settings(mode=ALL), Clock(tick))
            assert row["collected"] == count
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)
    cursor = state.read_cursor(spark, OPEN)
    assert cursor["last_trade_time"] == OPEN + timedelta(seconds=360)
    # The initial cycle counts, and the one that brought something.
    assert cursor["total_cycles_completed"] == 2
    assert state.read_seen(spark, 5).count() == 1


def test_switched_off(spark, tmp_path):
    state = CollectorState(str(tmp_path / "state"))
    job = Settings(enabled=False)
    trades = spark.createDataFrame([], SCHEMA)
    assert loads.run_cycle(trades, state, FileSink(str(tmp_path)), job) is None


def test_unreadable_cursor_means_a_new_initial_load(spark, tmp_path):
    trades = spark.createDataFrame(day_of_trades(2), SCHEMA)
    state = CollectorState(str(tmp_path / "state"))
    sink = FileSink(str(tmp_path / "topic"))
    job = Settings(mode=ALL)
    for tick in (1800, 1803):
        loads.run_cycle(trades, state, sink, job, Clock(tick))
    assert state.read_cycles(spark).count() == 2
    for file in (tmp_path / "state" / "cursor").rglob("*.json"):
        file.write_text('{"last_trade_time": "2024-')
        crc = file.parent / f".{file.name}.crc"
        crc.unlink(missing_ok=True)
    cursor = state.read_cursor(spark, OPEN + timedelta(hours=2))
    assert cursor["version"] == -1 and not cursor["initial_load_complete"]
    assert cursor["last_trade_time"] == OPEN
    assert loads.run_cycle(trades, state, sink, job, Clock(1900))["kind"] == "initial"
    assert [r.kind for r in state.read_cycles(spark).collect()] == ["initial"]


def test_seen_set_of_another_cycle_is_refused(spark, tmp_path):
    state = CollectorState(str(tmp_path))
    state.write_seen(spark.createDataFrame([("A", 1)], "secid string, tradeno bigint"), 4)
    assert state.read_seen(spark, 4).count() == 1
    with pytest.raises(RuntimeError):
        state.read_seen(spark, 2)
    assert state.read_seen(spark, -1).count() == 0


def overlapping_files(spark, sf_dir, folder):
    """Three files whose id ranges overlap, as after two restarts."""
    events = views.event_trades(views.table(spark, sf_dir, "events"))
    step = events.count() // 3
    ranges = [(0, step + 50), (step, 2 * step + 50), (2 * step, 3 * step + 50)]
    for i, (a, b) in enumerate(ranges):
        part = events.filter((F.col("tradeno") >= a) & (F.col("tradeno") < b))
        part.coalesce(1).write.parquet(f"{folder}/part{i}")
    return events.filter(F.col("tradeno") < 3 * step + 50)


def stream_of(spark, events, folder):
    return (
        spark.readStream.schema(events.schema)
        .option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true")
        .parquet(str(folder))
    )


def test_stream_gives_the_rows_of_the_batch(spark, sf_dir, tmp_path):
    folder = tmp_path / "landing"
    events = overlapping_files(spark, sf_dir, folder)
    state = CollectorState(str(tmp_path / "state"))
    sink = FileSink(str(tmp_path / "topic"))
    job = Settings(mode=ALL)

    def run():
        source = stream_of(spark, events, folder)
        collector.stream_trades(source, state, sink, job, once=True).awaitTermination()
        return topic.read_topic(spark, sink.path, TRADES_TOPIC)

    keys = Counter(r.key for r in run().collect())
    wanted = {f"{r.secid}:{r.tradeno}" for r in events.collect()}
    assert set(keys) == wanted and set(keys.values()) == {1}
    log = state.read_cycles(spark).orderBy("cycle").collect()
    assert [r.cycle for r in log] == [0, 1, 2]
    assert [r.duplicates for r in log] == [0, 50, 50]
    cursor = state.read_cursor(spark, OPEN)
    assert cursor["total_trades_collected"] == len(wanted)
    # Nothing new: a further run adds nothing.
    assert Counter(r.key for r in run().collect()) == keys
    # New files go on from the checkpoint and the state.
    extra = events.limit(20).withColumn("tradeno", F.col("tradeno") + 10_000_000)
    extra.unionByName(events.limit(5)).coalesce(1).write.parquet(f"{folder}/late")
    assert sum(Counter(r.key for r in run().collect()).values()) == len(wanted) + 20


def test_a_batch_delivered_again_replaces_its_output(spark, sf_dir, tmp_path):
    events = views.event_trades(views.table(spark, sf_dir, "events"))
    state = CollectorState(str(tmp_path / "state"))
    sink = FileSink(str(tmp_path / "topic"))
    work = collector.collect_batch(state, sink, Settings(mode=ALL), Clock(60))
    first = events.filter("tradeno < 300")
    second = events.filter("tradeno >= 250 and tradeno < 500")
    for batch, batch_id in [(first, 0), (first, 0), (second, 1), (second, 1)]:
        work(batch, batch_id)
    sent = topic.read_topic(spark, sink.path, TRADES_TOPIC)
    assert sent.count() == sent.select("key").distinct().count() == 500
    assert state.read_cursor(spark, OPEN)["total_trades_collected"] == 500
    totals = cycles.metrics_totals(state.read_cycles(spark)).first()
    assert (totals.total_trades_collected, totals.total_duplicates_filtered) == (500, 50)


def test_the_job_from_landed_responses(spark, tmp_path):
    rows = [[n, f"2024-01-15 10:00:{n:02d}", "SBER" if n % 2 else "GAZP", "TQBR", 1.5, n, 2]
            for n in range(20)]
    header = ["TRADENO", "TRADETIME", "SECID", "BOARDID", "PRICE", "QUANTITY", "VALUE"]
    base = tmp_path / "landing" / "stock" / "shares"
    for block in ("trades", "securities"):
        (base / block).mkdir(parents=True)
    for i, part in enumerate((rows[:12], rows[8:])):
        body = {"trades": {"columns": header, "data": part}}
        (base / "trades" / f"{i}.json").write_text(json.dumps(body))
    body = {"securities": {"columns": ["SECID", "BOARDID"], "data": [["SBER", "TQBR"]]}}
    (base / "securities" / "0.json").write_text(json.dumps(body))
    arguments = ["--landing", str(tmp_path / "landing"), "--state", str(tmp_path / "state")]
    arguments += ["--topics", str(tmp_path / "topics"), "--once"]
    job.main([*arguments, "--mode", "ALL"])
    sent = topic.read_topic(spark, str(tmp_path / "topics"), TRADES_TOPIC)
    assert sorted(int(r.key.split(":")[1]) for r in sent.collect()) == list(range(20))
    told = topic.read_topic(spark, str(tmp_path / "topics"), "instruments")
    assert [r.key for r in told.collect()] == ["SBER"]
    job.main([*arguments, "--mode", "ALL"])
    assert sent.count() == 20


def test_the_job_for_listed_symbols(spark, tmp_path):
    base = tmp_path / "landing" / "stock" / "shares" / "trades"
    base.mkdir(parents=True)
    data = [[1, "2024-01-15 10:00:00", "SBER"], [2, "2024-01-15 10:00:00", "GAZP"]]
    body = {"trades": {"columns": ["TRADENO", "TRADETIME", "SECID"], "data": data}}
    (base / "0.json").write_text(json.dumps(body))
    arguments = ["--landing", str(tmp_path / "landing"), "--state", str(tmp_path / "state")]
    arguments += ["--topics", str(tmp_path / "topics"), "--once", "--symbols", "GAZP"]
    job.main(arguments)
    sent = topic.read_topic(spark, str(tmp_path / "topics"), TRADES_TOPIC)
    assert [r.key for r in sent.collect()] == ["GAZP:2"]


def test_copies_pass_when_asked(spark, tmp_path):
    rows = [trade("A", 1, 1), trade("A", 1, 2), trade("A", 2, 3)]
    trades = spark.createDataFrame(rows, SCHEMA)
    job = Settings(mode=ALL)
    for dedupe, count in [(True, 2), (False, 3)]:
        state = CollectorState(str(tmp_path / f"state{count}"))
        sink = FileSink(str(tmp_path / f"topic{count}"))
        row = loads.run_cycle(trades, state, sink, job, Clock(60), dedupe=dedupe)
        assert row["collected"] == count


@pytest.mark.parametrize("slices", [1, 16])
def test_time_bounded_deduplication(spark, sf_dir, tmp_path, slices):
    folder = tmp_path / "landing"
    events = overlapping_files(spark, sf_dir, folder)
    query = (
        collector.dedup_stream(stream_of(spark, events, folder), slices=slices)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    out = spark.read.parquet(str(tmp_path / "out"))
    assert out.count() == events.count() == out.select("secid", "tradeno").distinct().count()


def test_message_values(spark):
    trades = spark.createDataFrame(
        [trade("SBER", 1234567890, 37_845, "258.50", 100)], SCHEMA
    )
    (row,) = trade_messages(trades, datetime(2024, 1, 15, 10, 30, 45)).collect()
    assert (row.topic, row.key) == ("trades", "SBER:1234567890")
    body = json.loads(row.value, parse_float=Decimal)
    assert list(body) == [
        "tradeno",
        "tradetime",
        "secid",
        "boardid",
        "price",
        "quantity",
        "value",
        "period",
        "tradingsession",
        "buysell",
        "systime",
        "ts_offset",
        "totalVolume",
        "timestamp",
    ]
    assert body["tradetime"] == "2024-01-15 10:30:45" and body["price"] == Decimal("258.5")
    assert body["totalVolume"] == 25850 and body["value"] == 25850
    assert body["timestamp"] == 1705314645000 and body["period"] is None
    sent = trade_messages(trades, datetime(2024, 1, 15, 10, 30, 45))
    (back,) = topic.message_trades(sent).collect()
    (first,) = trades.collect()
    assert {n: back[n] for n in trades.columns} == first.asDict()
    assert back.totalVolume == 25850 and back.timestamp == 1705314645000


def test_both_topics_below_one_path(spark, sf_dir, tmp_path):
    sink = FileSink(str(tmp_path))
    securities = views.part_securities(views.table(spark, sf_dir, "part"))
    ids = loads.load_instruments(securities, sink)
    assert ids.count() == securities.count()
    sink_trades(spark.createDataFrame([trade("A", 1, 1)], SCHEMA), sink, OPEN)
    sink_securities(securities, sink)  # again: replaces, and leaves the trades
    held = topic.read_topic(spark, sink.path, "instruments")
    assert held.count() == securities.count()
    wanted = {r.value for r in security_messages(securities).collect()}
    assert {r.value for r in held.collect()} == wanted
    lines = topic.scan_topic(topic.read_topic(spark, sink.path, TRADES_TOPIC)).collect()
    assert len(lines) == 1 and lines[0].line.startswith('A:1 | {"tradeno":1,')
    counts = topic.topic_counts(topic.read_topic(spark, sink.path, TRADES_TOPIC), 3)
    assert sorted(r.messages for r in counts.collect()) == [0, 0, 1]


def sent_keys(spark, path):
    return Counter(r.key for r in topic.read_topic(spark, str(path), TRADES_TOPIC).collect())


def lose_cursor(root):
    for file in (root / "cursor").rglob("*.json"):
        file.write_text('{"last_trade_time": "2024-')
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)


def test_a_lost_cursor_sends_again_and_deletes_nothing(spark, tmp_path):
    trades = spark.createDataFrame([trade("A", 1, 10), trade("A", 2, 1000)], SCHEMA)
    state = CollectorState(str(tmp_path / "state"), log_block=2)
    sink, job = FileSink(str(tmp_path / "topic")), Settings(mode=ALL)
    for tick in (60, 120):
        loads.run_cycle(trades, state, sink, job, Clock(tick))
    lose_cursor(tmp_path / "state")
    assert loads.run_cycle(trades, state, sink, job, Clock(1200))["kind"] == "initial"
    assert sent_keys(spark, sink.path) == {"A:1": 2, "A:2": 1}
    loads.run_cycle(trades, state, sink, job, Clock(1260))
    assert [r.cycle for r in state.read_cycles(spark).orderBy("cycle").collect()] == [0, 1]
    assert cycles.metrics_totals(state.read_cycles(spark)).first().total_trades_collected == 2
    # A state of its own below the same topic: the same again.
    loads.run_cycle(trades, CollectorState(str(tmp_path / "new")), sink, job, Clock(1200))
    assert sent_keys(spark, sink.path) == {"A:1": 3, "A:2": 2}


def test_a_retried_cycle_keeps_its_window(spark, tmp_path):
    trades = spark.createDataFrame([trade("A", 1, 355)], SCHEMA)
    state, job = CollectorState(str(tmp_path / "state")), Settings(mode=ALL)
    good = FileSink(str(tmp_path / "topic"))

    class Broken(FileSink):
        def write(self, messages, batch_id=0):
            super().write(messages, batch_id)
            raise OSError("lost")

    loads.run_cycle(trades, state, good, job, Clock(0))
    with pytest.raises(OSError):
        loads.run_cycle(trades, state, Broken(good.path), job, Clock(359))
    assert sent_keys(spark, good.path) == {"A:1": 1}
    row = loads.run_cycle(trades, state, good, job, Clock(700))
    assert (row["cycle"], row["till"]) == (1, OPEN + timedelta(seconds=359))
    while loads.run_cycle(trades, state, good, job, Clock(700))["till"] < OPEN + timedelta(seconds=700):
        pass
    assert sent_keys(spark, good.path) == {"A:1": 1}


def test_a_replay_without_rows_replaces_too(spark, tmp_path):
    sink = FileSink(str(tmp_path))
    some = spark.createDataFrame([trade("A", 1, 1)], SCHEMA)
    sink_trades(some, sink, OPEN, 3)
    sink_trades(some.limit(0), sink, OPEN, 3)
    sink_trades(some, sink, OPEN, 4)
    assert sent_keys(spark, tmp_path) == {"A:1": 1}


def land(folder, name, numbers, cut=0):
    rows = [[n, "2024-01-15 10:00:00", "SBER", "TQBR", 1.5, 1, 1.5] for n in numbers]
    header = ["TRADENO", "TRADETIME", "SECID", "BOARDID", "PRICE", "QUANTITY", "VALUE"]
    text = json.dumps({"trades": {"columns": header, "data": rows}})
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_text(text[: len(text) - cut])


def test_the_job_does_not_pass_over_a_cut_off_file(spark, tmp_path, capsys):
    folder = tmp_path / "landing" / "stock" / "shares" / "trades"
    land(folder, "good.json", range(10))
    land(folder, "cut.json", range(10, 20), cut=5)
    arguments = ["--landing", str(tmp_path / "landing"), "--state", str(tmp_path / "state")]
    arguments += ["--topics", str(tmp_path / "topics"), "--once", "--symbols", "SBER"]
    arguments += ["--tries", "2", "--interval", "0.1"]
    with pytest.raises(Exception, match="cut.json"):
        job.main(arguments)
    state = CollectorState(str(tmp_path / "state"))
    assert cycles.error_count(state.read_cycles(spark)).first().total_errors == 2
    assert state.read_cursor(spark, OPEN)["version"] == -1
    assert not (tmp_path / "topics").exists()
    job.main([*arguments, "--on-fault", "quarantine"])
    assert sorted(sent_keys(spark, tmp_path / "topics")) == [f"SBER:{n}" for n in range(10)]
    (kept,) = state.read_quarantine(spark).collect()
    assert kept.file.endswith("cut.json") and kept.fault == "broken JSON or block"
    capsys.readouterr()
    job.main(["--state", str(tmp_path / "state"), "--status", "--symbols", "SBER"])
    report = json.loads(capsys.readouterr().out)
    assert (report["total_trades_collected"], report["total_errors"], report["quarantined"]) == (10, 2, 1)


def test_a_sink_that_fails_once_delays_and_loses_nothing(spark, tmp_path):
    folder = tmp_path / "landing"
    rows = [trade("A", n, n) for n in range(30)]
    for i in range(3):
        spark.createDataFrame(rows[i * 10 :][:15], SCHEMA).coalesce(1).write.parquet(f"{folder}/{i}")
    failures = [2]

    class Shaky(FileSink):
        def write(self, messages, batch_id=0):
            if batch_id == failures[0]:
                failures[0] = None
                raise OSError("away")
            super().write(messages, batch_id)

    state, sink = CollectorState(str(tmp_path / "state")), Shaky(str(tmp_path / "topic"))
    schema = spark.createDataFrame(rows, SCHEMA)
    collector.keep_collecting(
        lambda: collector.stream_trades(stream_of(spark, schema, folder), state, sink, Settings(mode=ALL), once=True),
        tries=2,
        pause=0.1,
    )
    assert sent_keys(spark, sink.path) == {f"A:{n}": 1 for n in range(30)}
    assert cycles.error_count(state.read_cycles(spark)).first().total_errors == 1


def test_the_job_in_cycles_with_times_of_day(spark, tmp_path):
    folder = tmp_path / "landing" / "stock" / "shares" / "trades"
    folder.mkdir(parents=True)
    today = datetime.now().strftime("%Y-%m-%d")
    body = {"trades": {"columns": ["TRADENO", "TRADETIME", "SECID"], "data": [[1, "00:00:00", "A"]]}}
    (folder / "0.json").write_text(json.dumps(body))
    arguments = ["--landing", str(tmp_path / "landing"), "--state", str(tmp_path / "state"), "--topics", str(tmp_path / "topics")]
    arguments += ["--mode", "ALL", "--cycle", "--once", "--trade-date", today, "--interval", "0.1"]
    job.main([*arguments, "--disabled"])
    assert not (tmp_path / "topics").exists()
    job.main(arguments)
    job.main(arguments)
    assert sent_keys(spark, tmp_path / "topics") == {"A:1": 1}
    log = CollectorState(str(tmp_path / "state")).read_cycles(spark).orderBy("cycle").collect()
    assert [r.kind for r in log] == ["initial", "incremental"]


def test_every_number_is_kept_without_a_cap(spark, tmp_path):
    rows = [trade("A", n, n) for n in range(25)]
    trades = spark.createDataFrame(rows, SCHEMA)
    for cap, copies in [(10, 40), (None, 25)]:
        state, sink = CollectorState(str(tmp_path / f"s{cap}")), FileSink(str(tmp_path / f"t{cap}"))
        work = collector.collect_batch(state, sink, Settings(mode=ALL, seen_cap=cap), Clock(60))
        work(trades, 0)
        work(trades, 1)
        assert sum(sent_keys(spark, sink.path).values()) == copies


def test_rows_late_or_without_time_are_delivered_once(spark, tmp_path):
    folder = tmp_path / "landing"
    days = [0, 200, 90, 5, 200]
    for i, day in enumerate(days):
        rows = [trade("A", day, day * 86_400), (*trade("B", 1, 0)[:12], None), trade("A", 200, 200 * 86_400)]
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{folder}/{i}")
    query = (
        collector.dedup_stream(stream_of(spark, spark.createDataFrame([], SCHEMA), folder))
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    found = Counter((r.secid, r.tradeno) for r in spark.read.parquet(str(tmp_path / "out")).collect())
    assert found == {("A", 0): 1, ("A", 5): 1, ("A", 90): 1, ("A", 200): 1, ("B", 1): 1}


def test_a_small_batch_leaves_other_buckets_unwritten(spark, tmp_path):
    state, sink = CollectorState(str(tmp_path / "state")), FileSink(str(tmp_path / "topic"))
    work = collector.collect_batch(state, sink, Settings(mode=ALL), Clock(60))
    first = [trade(f"S{i}", n, n) for i in range(40) for n in range(5)]
    work(spark.createDataFrame(first, SCHEMA), 0)

    def files():
        found = (tmp_path / "state").rglob("seen/bucket=*/slot=*/*.parquet")
        return {str(f.relative_to(tmp_path)): f.stat().st_mtime_ns for f in found}

    before = files()
    work(spark.createDataFrame([trade("S7", 100, 1), trade("S7", 3, 1)], SCHEMA), 1)
    after = files()
    assert before.items() <= after.items() and len(after) == len(before) + 1
    work(spark.createDataFrame([trade("S7", 100, 1), trade("S8", 4, 1)], SCHEMA), 2)
    assert files() == after
    assert sum(sent_keys(spark, sink.path).values()) == 201
    assert state.read_seen(spark, 2).count() == 201


def caught_up(spark, tmp_path, trades, name, ticks, most, cap, minutes=5, log_block=1000):
    state = CollectorState(str(tmp_path / name / "state"), log_block=log_block)
    sink = FileSink(str(tmp_path / name / "topic"))
    clock = Clock(0)
    made = 0
    for tick in ticks:
        clock = Clock(tick)
        while True:
            row = loads.run_cycle(
                trades, state, sink, Settings(mode=ALL, seen_cap=cap, catch_up_minutes=minutes), clock, most_windows=most
            )
            made += 1
            if row["till"] == clock():
                break
    sent = topic.read_topic(spark, sink.path, TRADES_TOPIC)
    log = state.read_cycles(spark).orderBy("cycle").collect()
    cursor = state.read_cursor(spark, OPEN)
    seen = {tuple(r) for r in state.read_seen(spark, cursor["version"]).collect()}
    messages = Counter((r.batch_id, r.key, r.value.split('"timestamp"')[0]) for r in sent.collect())
    return made, log, messages, cursor, seen


@pytest.mark.parametrize("cap, log_block", [(None, 7), (10_000, 1000)])
def test_many_windows_in_one_job(spark, tmp_path, cap, log_block):
    """The same log, messages, cursor and seen-set as single ticks, in fewer jobs."""
    trades = spark.createDataFrame(day_of_trades(3, 300), SCHEMA).cache()
    ticks = [60, 2401]
    one = caught_up(spark, tmp_path, trades, "one", ticks, 1, cap, log_block=log_block)
    many = caught_up(spark, tmp_path, trades, "many", ticks, 501, cap, log_block=log_block)
    assert many[0] < one[0]  # jobs
    drop = ("started", "ended")
    same = [[{k: v for k, v in r.asDict().items() if k not in drop} for r in found[1]] for found in (one, many)]
    assert same[0] == same[1] and len(same[0]) == one[0]
    assert one[2] == many[2]
    assert {k: v for k, v in one[3].items() if k != "last_update_time"} == {
        k: v for k, v in many[3].items() if k != "last_update_time"
    }
    assert one[4] == many[4]


def test_windows_that_broke_off_are_done_again_together(spark, tmp_path):
    trades = spark.createDataFrame(day_of_trades(5, 200), SCHEMA)
    state, sink = CollectorState(str(tmp_path / "state")), FileSink(str(tmp_path / "topic"))
    job = Settings(mode=ALL)
    loads.run_cycle(trades, state, sink, job, Clock(60))

    class Broken(FileSink):
        def write(self, messages, batch_id=0):
            super().write(messages, batch_id)
            raise OSError("away")

    with pytest.raises(OSError):
        loads.run_cycle(trades, state, Broken(sink.path), job, Clock(3700), most_windows=501)
    assert state.read_cursor(spark, OPEN)["version"] == 0
    # Done again by a tick that would take one window, later: the plan holds.
    row = loads.run_cycle(trades, state, sink, job, Clock(9000))
    assert row["cycle"] == 11 and row["till"] == OPEN + timedelta(seconds=60 + 11 * 300)
    sent = topic.read_topic(spark, sink.path, TRADES_TOPIC).collect()
    assert max(Counter(r.key for r in sent).values()) == 1
    assert len(sent) == sum(r.collected for r in state.read_cycles(spark).filter("status = 'ok'").collect())


def test_copies_pass_window_by_window(spark, tmp_path):
    trades = spark.createDataFrame([trade("A", 1, 400), trade("A", 1, 401), trade("A", 1, 900)], SCHEMA)
    state, sink = CollectorState(str(tmp_path / "state")), FileSink(str(tmp_path / "topic"))
    for at in (60, 3660):
        row = loads.run_cycle(trades, state, sink, Settings(mode=ALL), Clock(at), dedupe=False, most_windows=99)
    assert row["cycle"] == 1 and row["till"] == OPEN + timedelta(seconds=360)


def test_a_stream_keeps_each_key_once_in_rocksdb(spark, tmp_path):
    folder = tmp_path / "landing"
    for i in range(3):
        keys = spark.range(0, 30_000, 1, 4).selectExpr(
            "IF(id % 3 = 0, 'HOT', 'A') AS secid", f"IF(id % 3 = 0, 7, id + {1000 * i}) AS tradeno", "id AS boardid"
        )
        keys.write.parquet(f"{folder}/{i}")
    stream = spark.readStream.schema(keys.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 4)
    query = (
        collector.dedup_stream(stream.parquet(str(folder)))
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "checkpoint"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    query.awaitTermination()
    found = spark.read.parquet(str(tmp_path / "out"))
    wanted = {("HOT", 7)} | {("A", n + 1000 * i) for i in range(3) for n in range(30_000) if n % 3}
    assert found.count() == len(wanted) and {(r.secid, r.tradeno) for r in found.collect()} == wanted
    progress = query.lastProgress
    (operator,) = progress["stateOperators"]
    assert operator["numRowsTotal"] == len(wanted)  # once, not once per step
    assert "rocksdbCommitFlushLatency" in str(operator["customMetrics"])
    # Of 30,000 rows a third are copies of one key; of these each batch of rows sends one.
    assert all(p["stateOperators"][0]["customMetrics"]["numDroppedDuplicateRows"] < 21_000 for p in query.recentProgress)
    delta = list((tmp_path / "checkpoint" / "state").rglob("*.changelog"))
    assert delta


def test_a_second_collector_takes_the_state_over(spark, tmp_path):
    trades = spark.createDataFrame(day_of_trades(2, 60), SCHEMA)
    root, job = str(tmp_path / "state"), Settings(mode=ALL)
    sink = FileSink(str(tmp_path / "topic"))
    first = CollectorState(root).claim(spark)
    loads.run_cycle(trades, first, sink, job, Clock(60))
    second = CollectorState(root).claim(spark)
    assert second.epoch == first.epoch + 1
    with pytest.raises(Superseded):
        loads.run_cycle(trades, first, sink, job, Clock(300))
    assert first.read_cursor(spark, OPEN)["version"] == 0
    assert loads.run_cycle(trades, second, sink, job, Clock(300))["cycle"] == 1
    assert cycles.error_count(second.read_cycles(spark)).first().total_errors == 0


def test_a_cycle_under_way_does_not_commit_once_superseded(spark, tmp_path):
    trades = spark.createDataFrame(day_of_trades(2, 60), SCHEMA)
    root, job = str(tmp_path / "state"), Settings(mode=ALL)
    claims = []

    class Overtaken(FileSink):
        def write(self, messages, batch_id=0):
            super().write(messages, batch_id)
            claims.append(CollectorState(root).claim(spark))

    first = CollectorState(root).claim(spark)
    with pytest.raises(Superseded):
        loads.run_cycle(trades, first, Overtaken(str(tmp_path / "topic")), job, Clock(60))
    assert first.read_cursor(spark, OPEN)["version"] == -1
    row = loads.run_cycle(trades, claims[0], FileSink(str(tmp_path / "topic")), job, Clock(900))
    assert row["cycle"] == 0 and row["till"] == OPEN + timedelta(seconds=60)
    assert max(sent_keys(spark, tmp_path / "topic").values()) == 1


def test_a_landed_folder_has_more_files_the_more_trades_there_are(spark, tmp_path, monkeypatch):
    """And is still one micro-batch."""
    monkeypatch.setattr(views, "FILE_ROWS", 100)
    trades = spark.range(1500).selectExpr("'A' AS secid", "id AS tradeno")
    parts = views.overlapping_files(trades, f"{tmp_path}/landing")
    sizes = []
    (
        views.landed_stream(spark, trades.schema, f"{tmp_path}/landing", parts)
        .writeStream.foreachBatch(lambda batch, _: sizes.append(batch.count()))
        .option("checkpointLocation", f"{tmp_path}/checkpoint")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    assert parts == 10 and len(sizes) == 3
    assert sum(sizes) == 3000 and all(spark.read.parquet(f"{tmp_path}/landing/{i}").count() == n for i, n in enumerate(sizes))
    assert len(spark.read.parquet(f"{tmp_path}/landing/0").inputFiles()) == 10


def test_kept_trades_lie_in_files_of_bounded_length(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(state_module, "KEPT_ROWS", 100)
    kept = CollectorState(str(tmp_path)).stage_fetched(spark.range(0, 1000, 1, 1), 0)
    assert len(kept.inputFiles()) == 10 and kept.count() == 1000


def test_tasks_of_a_batch_take_little_unless_the_session_says_so(spark):
    mine, theirs = collector.SHORT
    spark.conf.set(theirs, "32m")
    try:
        with collector._short_tasks(spark):
            assert spark.conf.get(mine) == collector.SHORT[mine] and spark.conf.get(theirs) == "32m"
        assert spark.conf.get(mine, None) is None and spark.conf.get(theirs) == "32m"
    finally:
        spark.conf.unset(theirs)


def test_the_keys_of_the_watermark_stream_are_not_counted(spark, tmp_path, monkeypatch):
    """While the query runs, and the session is left as it was."""
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    lines = spark.range(0, 60, 1, 1).selectExpr(
        "id % 30 AS l_orderkey", "1 AS l_linenumber", "2.0D AS l_quantity", "3.0D AS l_extendedprice",
        "'A' AS l_returnflag", "'O' AS l_linestatus", "timestamp_ntz'1996-01-01 00:00:00' AS l_shipdate",
    )
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    dedup, held = collector.dedup_stream, []
    monkeypatch.setattr(collector, "dedup_stream", lambda s: held.append(spark.conf.get(key)) or dedup(s))
    found = catalog.queries()["stream_watermark"](spark, str(tmp_path)).collect()
    assert sorted(r.tradeno for r in found) == [10 * i + 1 for i in range(30)]
    assert held == ["false"] and spark.conf.get(key, None) is None
