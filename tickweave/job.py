"""The collector as a job for spark-submit.

    spark-submit tickweave/job.py --landing DIR --state DIR --topics DIR --mode ALL --once

collects as a stream of what lands; with ``--cycle`` each tick is one cycle driven
by the cursor; ``--status`` prints what a state folder says and ends. The package
must be on the Python path of the driver. Responses land below
``DIR/<engine>/<market>/{trades,securities}``. All folders must be ones that
every executor reaches.
"""

from __future__ import annotations

import argparse
import sys
import time
from collections.abc import Sequence
from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tickweave.operators.cursor import collector_status
from tickweave.plans.archive import TradeArchive
from tickweave.plans.loads import Landed, load_instruments, run_cycle
from tickweave.plans.state import CollectorState
from tickweave.settings import (
    ALL,
    FAIL,
    PAGE_SIZE,
    QUARANTINE,
    SEEN_CAP,
    SPECIFIC,
    TRIGGER_SECONDS,
    Settings,
    session,
)
from tickweave.sinks.messages import FileSink, KafkaSink
from tickweave.sources.envelope import list_securities, list_trades
from tickweave.streaming.collector import keep_collecting, stream_trades


def arguments(argv: Sequence[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Collect landed trades into a topic.")
    parser.add_argument("--landing", help="folder of landed responses")
    parser.add_argument("--state", required=True, help="folder of state and checkpoint")
    parser.add_argument("--topics", help="folder to write the topics to")
    parser.add_argument("--servers", help="broker to write the topics to")
    parser.add_argument("--engine", default="stock")
    parser.add_argument("--market", default="shares")
    parser.add_argument("--layout", choices=["file", "line"], default="file")
    parser.add_argument("--mode", choices=[ALL, SPECIFIC], default=SPECIFIC)
    parser.add_argument("--symbols", nargs="*", default=[])
    parser.add_argument("--page-size", type=int, default=PAGE_SIZE)
    parser.add_argument(
        "--seen-cap", type=int, default=SEEN_CAP, help="per instrument; 0 keeps all"
    )
    parser.add_argument("--trade-date", help="the day, for feeds with time of day alone")
    parser.add_argument("--interval", type=float, default=TRIGGER_SECONDS, help="seconds")
    parser.add_argument("--tries", type=int, default=3, help="failures in a row that end it")
    parser.add_argument("--on-fault", choices=[FAIL, QUARANTINE], default=FAIL)
    parser.add_argument("--disabled", action="store_true", help="collect nothing")
    parser.add_argument("--cycle", action="store_true", help="cycles driven by the cursor")
    parser.add_argument(
        "--windows", type=int, default=501, help="of a gap that one cycle may catch up on"
    )
    parser.add_argument("--status", action="store_true", help="print the state and end")
    parser.add_argument("--max-files", default="1000", help="files per micro-batch")
    parser.add_argument("--once", action="store_true", help="take what is there and stop")
    options = parser.parse_args(argv)
    if options.status:
        return options
    if not options.landing:
        parser.error("give --landing")
    if bool(options.topics) == bool(options.servers):
        parser.error("give either --topics or --servers")
    return options


def status(spark: SparkSession, state: CollectorState, settings: Settings) -> str:
    """Settings, cursor and counters of a state folder, as JSON."""
    now = datetime.now()
    report = collector_status(
        state.read_cycles(spark), now, settings.mode, settings.symbols, settings.enabled
    )
    quarantined = state.read_quarantine(spark).count()
    named = report.withColumn("quarantined", F.lit(quarantined))
    return "\n".join(named.toJSON().collect())  # one row per run


def main(argv: Sequence[str] | None = None) -> None:
    given = arguments(argv)
    settings = Settings(
        enabled=not given.disabled,
        mode=given.mode,
        symbols=given.symbols,
        page_size=given.page_size,
        seen_cap=given.seen_cap or None,
        on_fault=given.on_fault,
    )
    spark = session()
    state = CollectorState(given.state)
    if given.status:
        print(status(spark, state, settings))
        return
    if not settings.enabled:
        return
    state = state.claim(spark)
    sink = FileSink(given.topics) if given.topics else KafkaSink(given.servers)
    place = (spark, given.landing, given.engine, given.market, given.layout)
    if settings.mode == ALL:
        try:
            load_instruments(list_securities(*place), sink)
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            print("no instruments landed; collecting trades alone", file=sys.stderr)
    decoding = {"trade_date": given.trade_date, "faults": True}
    if given.cycle:
        failures = 0
        pace = {"maxFilesPerTrigger": given.max_files}
        landed = Landed(
            spark,
            TradeArchive(f"{given.state}/archive"),
            lambda: list_trades(*place, streaming=True, **decoding, **pace),
        )
        while True:
            try:
                run_cycle(landed, state, sink, settings, most_windows=given.windows)
                failures = 0
            except Exception:
                failures += 1
                if failures >= given.tries:
                    raise
            else:
                if given.once:
                    return
            time.sleep(given.interval)

    pace = {"maxFilesPerTrigger": given.max_files}
    trades = list_trades(*place, streaming=True, **decoding, **pace)
    keep_collecting(
        lambda: stream_trades(
            trades, state, sink, settings, once=given.once, interval=given.interval
        ),
        given.tries,
        given.interval,
    )


if __name__ == "__main__":
    main()
