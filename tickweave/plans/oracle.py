"""The SQL each catalog entry must agree with, for an engine that reads the
same tables under their own names."""

from __future__ import annotations

TRADES = """
trades AS (
  SELECT event_id AS tradeno,
         strftime(ts, '%Y-%m-%d %H:%M:%S') AS tradetime,
         event_type AS secid,
         'B' || CAST(user_id % 3 AS VARCHAR) AS boardid,
         CAST(value AS DECIMAL(18,6)) AS price,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS quantity,
         CAST(CAST(value AS DECIMAL(18,6))
              * CAST(json_extract_string(props, '$.k') AS DECIMAL(10,0))
              AS DECIMAL(24,6)) AS value,
         CASE WHEN event_id % 2 = 0 THEN 'B' ELSE 'S' END AS buysell,
         ts AS trade_ts
  FROM events)"""

LINES = """
lines AS (
  SELECT l_orderkey * 10 + l_linenumber AS tradeno,
         strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS tradetime,
         l_returnflag AS secid,
         l_linestatus AS boardid,
         CAST(floor(l_extendedprice / l_quantity * 1000000 + 0.5) / 1000000
              AS DECIMAL(18,6)) AS price,
         CAST(l_quantity AS BIGINT) AS quantity,
         CAST(l_extendedprice AS DECIMAL(24,6)) AS value,
         l_shipdate AS trade_ts
  FROM lineitem)"""

SECURITIES = """
securities AS (
  SELECT 'P' || CAST(p_partkey AS VARCHAR) AS secid,
         p_brand AS boardid,
         p_name AS shortname,
         p_type AS secname,
         CAST(p_retailprice AS DECIMAL(18,6)) AS prevprice,
         CAST(p_size AS INTEGER) AS lotsize
  FROM part)"""

SHOWN = """tradeno, tradetime, secid, boardid, CAST(price AS DOUBLE) AS price,
  quantity, CAST(value AS DOUBLE) AS value, buysell, trade_ts"""

SHOWN_LINES = """tradeno, tradetime, secid, boardid, CAST(price AS DOUBLE) AS price,
  quantity, CAST(value AS DOUBLE) AS value, trade_ts"""

SHOWN_SECURITIES = """secid, boardid, shortname, secname,
  CAST(prevprice AS DOUBLE) AS prevprice, lotsize"""

RANGE = """trade_ts BETWEEN TIMESTAMP '2024-01-08 00:00:00'
  AND TIMESTAMP '2024-01-19 12:30:45'"""

SYMBOLS = "secid IN ('click', 'purchase')"

SEEN = """
seen AS (
  SELECT secid, tradeno FROM trades
  WHERE trade_ts <= TIMESTAMP '2024-01-12 06:00:00')"""

CYCLES = """
days AS (
  SELECT boardid AS run_id, date_trunc('day', trade_ts) AS day,
         min(trade_ts) AS started, max(trade_ts) AS ended, count(*) AS n,
         count(*) FILTER (trade_ts <= TIMESTAMP '2024-01-12 06:00:00') AS known,
         max_by(secid, tradeno) AS closing
  FROM trades GROUP BY 1, 2),
cycles AS (
  SELECT run_id, date_diff('day', DATE '2024-01-01', CAST(day AS DATE)) AS cycle,
         CASE WHEN CAST(day AS DATE) = DATE '2024-01-01' THEN 'initial'
              ELSE 'incremental' END AS kind,
         started, ended, CAST(day AS TIMESTAMP) + INTERVAL 1 DAY AS till,
         n - known AS collected, known AS duplicates, n // 5000 + 1 AS api_calls,
         CASE WHEN closing = 'error' THEN 'error' ELSE 'ok' END AS status
  FROM days)"""

BROKEN = """
broken AS (
  SELECT tradeno, tradetime, secid,
         CASE WHEN secid = 'signup' THEN '' ELSE boardid END AS boardid,
         CASE WHEN secid = 'view' THEN 0 ELSE CAST(price AS DOUBLE) END AS price,
         CASE WHEN secid IN ('click', 'signup') THEN 0 ELSE quantity END AS quantity,
         CASE WHEN secid = 'click' THEN 0 ELSE CAST(value AS DOUBLE) END AS value,
         secid IN ('view', 'click', 'signup') AS is_defaulted,
         date_trunc('second', trade_ts) AS trade_ts
  FROM trades WHERE secid <> 'error')"""

TRADE_MESSAGE = """
  '{"tradeno":' || tradeno || ',"tradetime":"' || tradetime
  || '","secid":"' || secid || '","boardid":"' || boardid
  || '","price":' || CAST(price AS VARCHAR) || ',"quantity":' || quantity
  || ',"value":' || CAST(value AS VARCHAR)
  || ',"period":null,"tradingsession":null,"buysell":"' || buysell
  || '","systime":null,"ts_offset":null,"totalVolume":'
  || CAST(CAST(price * CAST(quantity AS DECIMAL(19,0)) AS DECIMAL(38,6)) AS VARCHAR)
  || ',"timestamp":1706745600123}'"""

SECURITY_MESSAGE = """
  '{"secid":"' || secid || '","boardid":"' || boardid
  || '","shortname":"' || shortname || '","secname":"' || secname
  || '","prevprice":' || CAST(prevprice AS VARCHAR) || ',"lotsize":' || lotsize
  || ',"facevalue":null,"status":null,"marketprice":null,"currencyid":null}'"""

MESSAGES = f"""
messages AS (
  SELECT secid || ':' || tradeno AS key, {TRADE_MESSAGE} AS value,
         CAST(CAST('0x' || substr(md5(secid || ':' || tradeno), 1, 8) AS BIGINT) % 3
              AS INTEGER) AS "partition"
  FROM trades)"""

LOADED = """secid || ':' || tradeno AS key, secid, tradeno, trade_ts,
  CAST(CAST(price * CAST(quantity AS DECIMAL(19,0)) AS DECIMAL(38,6)) AS DOUBLE)
  AS total_volume"""

TOP_SEEN = """
SELECT secid, tradeno FROM (
  SELECT secid, tradeno,
         row_number() OVER (PARTITION BY secid ORDER BY tradeno DESC) AS r
  FROM (SELECT DISTINCT secid, tradeno FROM lines))
WHERE r <= 10000"""

LINE_ORDER = """trade_ts, tradeno, secid, boardid, price, quantity, tradetime, value"""

# Windows of 5 minutes from a start until the rest is at most 5 whole minutes.
WHOLE_WINDOWS = """
  greatest(CAST(ceil(((epoch_us({now}) - epoch_us({start})) // 60000000 - 5) / 5.0)
  AS BIGINT), 0)"""

LAST_TRADE_TIME = """
  coalesce(max_by(till, cycle) FILTER (status = 'ok'), TIMESTAMP '2024-02-01 00:00:00')
    AS last_trade_time"""

CURSOR_COLUMNS = f"""
  {LAST_TRADE_TIME},
  bool_or(status = 'ok' AND kind = 'initial') AS initial_load_complete,
  CAST(coalesce(sum(collected) FILTER (status = 'ok'
       AND (kind = 'initial' OR collected > 0)), 0) AS BIGINT)
    AS total_trades_collected,
  count(*) FILTER (status = 'ok' AND (kind = 'initial' OR collected > 0))
    AS total_cycles_completed,
  coalesce(max_by(ended, cycle) FILTER (status = 'ok'),
           TIMESTAMP '2024-02-01 08:15:30.25') AS last_update_time"""

TOTAL_COLUMNS = """
  CAST(coalesce(sum(collected) FILTER (status = 'ok'), 0) AS BIGINT)
    AS total_trades_collected,
  CAST(coalesce(sum(duplicates) FILTER (status = 'ok'), 0) AS BIGINT)
    AS total_duplicates_filtered,
  count(*) FILTER (status = 'ok') AS total_cycles_completed,
  CAST(coalesce(sum(api_calls) FILTER (status = 'ok'), 0) AS BIGINT)
    AS total_api_calls,
  count(*) FILTER (status <> 'ok') AS total_errors"""

UPTIME = """CAST(floor((epoch_us(TIMESTAMP '2024-02-01 08:15:30.25')
  - epoch_us(min(started))) / 1000000.0) AS BIGINT) AS uptime_seconds"""


# Trades as responses bring them, with times of whole seconds.
LANDED = (
    TRADES.replace("trades AS", "exact AS", 1)
    + """, trades AS (
  SELECT * REPLACE (date_trunc('second', trade_ts) AS trade_ts) FROM exact)"""
)


def oracle_sql() -> dict[str, str]:
    named = _plain_sql()
    for landed, plain in {
        "archive_window": "filter_time_range",
        "archive_latest": "latest_trades",
        "archive_page": "trades_page",
        "archive_cycles": "collector_cycles",
    }.items():
        named[landed] = named[plain].replace(TRADES, LANDED, 1)
    named["filter_unseen"] = named["filter_new_trades"]
    named["decode_split"] = named["decode_trades"]
    return named


def _plain_sql() -> dict[str, str]:
    shown_range = f"WITH {TRADES} SELECT {SHOWN} FROM trades WHERE {RANGE}"
    return {
        "read_envelope": """
            SELECT 'trades' AS block, count(*) AS n_rows FROM events
            UNION ALL SELECT 'securities', count(*) FROM part""",
        "decode_trades": f"""WITH {TRADES}
            SELECT {SHOWN.replace("trade_ts", "date_trunc('second', trade_ts) AS trade_ts")},
                   false AS is_defaulted
            FROM trades""",
        "decode_securities": f"""WITH {SECURITIES}
            SELECT {SHOWN_SECURITIES} FROM securities""",
        "drop_malformed": f"""WITH {TRADES}
            SELECT CASE WHEN secid = 'click' THEN 5 ELSE 7 END AS n_cells,
                   count(*) AS n_rows
            FROM trades WHERE secid <> 'error' GROUP BY 1""",
        "default_fill": f"WITH {TRADES}, {BROKEN} SELECT * FROM broken",
        "decode_report": f"""WITH {TRADES}, {BROKEN}
            SELECT count(*) AS n_rows, count(*) FILTER (is_defaulted) AS defaulted,
                   without_time, unreadable, CAST(0 AS BIGINT) AS out_of_range
            FROM (SELECT is_defaulted, 0 AS extra FROM broken
                  UNION ALL SELECT true, 1 FROM trades
                  WHERE (tradeno // 500) % 10 NOT IN (3, 5, 7, 9)),
              (SELECT CAST(0 AS BIGINT) AS without_time,
                      count(DISTINCT tradeno // 500)
                        FILTER ((tradeno // 500) % 10 IN (3, 5, 7, 9)) AS unreadable
               FROM trades)
            GROUP BY without_time, unreadable""",
        "unreadable_responses": f"""WITH {TRADES}, placed AS (
              SELECT tradeno // 500 AS number,
                     CASE (tradeno // 500) % 10 WHEN 3 THEN 'broken JSON or block'
                       WHEN 5 THEN 'empty response' WHEN 7 THEN 'broken JSON or block'
                       WHEN 9 THEN 'no JSON object' ELSE 'none' END AS fault
              FROM trades)
            SELECT fault, CASE WHEN fault = 'none' THEN count(*)
                               ELSE count(DISTINCT number) END AS n
            FROM placed GROUP BY fault""",
        "decode_out_of_range": f"""WITH {TRADES}
            SELECT tradeno,
                   CASE WHEN tradeno % 10 IN (1, 2, 3) THEN 'number out of range'
                        ELSE 'none' END AS fault,
                   CASE WHEN tradeno % 10 NOT IN (1, 2, 3)
                        THEN CAST(price AS DOUBLE) END AS price
            FROM trades""",
        "list_securities": f"""WITH {SECURITIES}
            SELECT {SHOWN_SECURITIES} FROM securities""",
        "scan_topic": f"""WITH {TRADES}, {MESSAGES}
            SELECT key || ' | ' || value AS line FROM messages""",
        "topic_counts": f"""WITH {TRADES}, {MESSAGES}
            SELECT "partition", count(*) AS messages FROM messages GROUP BY 1""",
        "filter_symbol": f"""WITH {TRADES}
            SELECT {SHOWN} FROM trades WHERE secid = 'purchase'""",
        "filter_symbols": f"WITH {TRADES} SELECT {SHOWN} FROM trades WHERE {SYMBOLS}",
        "filter_symbols_table": f"""WITH {TRADES}
            SELECT {SHOWN} FROM trades
            WHERE secid IN (SELECT secid FROM trades WHERE price > 350)""",
        "filter_time_range": shown_range,
        "filter_symbol_time_range": f"{shown_range} AND secid = 'purchase'",
        "total_volume": f"""WITH {TRADES}, volumes AS (
              SELECT secid, tradeno,
                     CAST(price * CAST(quantity AS DECIMAL(19,0)) AS DECIMAL(38,6)) AS v
              FROM trades)
            SELECT secid, tradeno, CAST(v AS DOUBLE) AS total_volume,
                   CAST(v AS VARCHAR) AS digits
            FROM volumes""",
        "ingest_millis": f"""WITH {TRADES}
            SELECT secid, tradeno, CAST(1706745600123 AS BIGINT) AS ingested
            FROM trades""",
        "message_key": f"""WITH {LINES}
            SELECT secid || ':' || tradeno AS key FROM lines""",
        "format_time": f"""WITH {TRADES}
            SELECT tradeno, strftime(trade_ts, '%Y-%m-%d %H:%M:%S') AS bound
            FROM trades""",
        "start_of_day": f"""WITH {TRADES}
            SELECT tradeno, CAST(date_trunc('day', trade_ts) AS TIMESTAMP) AS midnight
            FROM trades""",
        "trade_json": f"""WITH {TRADES}
            SELECT tradeno, {TRADE_MESSAGE} AS message FROM trades""",
        "security_json": f"""WITH {SECURITIES}
            SELECT secid, {SECURITY_MESSAGE} AS message FROM securities""",
        "latest_trades": f"""WITH {TRADES}
            SELECT {SHOWN} FROM trades
            ORDER BY trades.trade_ts DESC, tradeno DESC LIMIT 100""",
        "latest_trades_symbol": f"""WITH {TRADES}
            SELECT {SHOWN} FROM trades WHERE secid = 'purchase'
            ORDER BY trades.trade_ts DESC, tradeno DESC LIMIT 100""",
        "trades_page": f"""WITH {TRADES}
            SELECT {SHOWN} FROM trades
            ORDER BY trades.trade_ts DESC, tradeno DESC LIMIT 2000 OFFSET 3000""",
        "trades_page_deep": f"""WITH {LINES}
            SELECT {SHOWN_LINES} FROM (
              SELECT * FROM lines ORDER BY {LINE_ORDER} LIMIT 5000 OFFSET 20000)""",
        "trades_range_page": f"""{shown_range}
            ORDER BY trades.trade_ts, tradeno LIMIT 1000 OFFSET 500""",
        "drain_range": shown_range,
        "drain_range_symbol": f"{shown_range} AND secid = 'purchase'",
        "page_assignment": f"""WITH {LINES}
            SELECT secid, trade_ts, tradeno,
                   (row_number() OVER (PARTITION BY secid ORDER BY trade_ts, tradeno)
                    - 1) // 5000 AS page
            FROM lines""",
        "page_assignment_all": f"""WITH {TRADES}
            SELECT secid, trade_ts, tradeno,
                   (row_number() OVER (ORDER BY trade_ts, tradeno, secid) - 1) // 500
                     AS page
            FROM trades""",
        "page_count": f"""WITH {LINES}
            SELECT secid, count(*) AS trades, count(*) // 5000 + 1 AS pages
            FROM lines GROUP BY secid""",
        "filter_new_trades": f"""WITH {LINES}
            SELECT {SHOWN_LINES} FROM lines t
            WHERE NOT EXISTS (
              SELECT 1 FROM lines s
              WHERE s.trade_ts <= TIMESTAMP '1996-01-01 00:00:00'
                AND s.secid = t.secid AND s.tradeno = t.tradeno)""",
        "dedup_trades": f"""WITH {LINES}
            SELECT {SHOWN_LINES} FROM (
              SELECT *, row_number() OVER (
                PARTITION BY secid, tradeno
                ORDER BY trade_ts, tradetime, boardid, price, quantity, value) AS r
              FROM lines)
            WHERE r = 1""",
        "union_symbols": f"""WITH {TRADES}
            SELECT {SHOWN} FROM trades WHERE secid = 'click'
            UNION ALL SELECT {SHOWN} FROM trades WHERE secid = 'purchase'""",
        "distinct_securities": f"""WITH {SECURITIES}
            SELECT DISTINCT secid FROM securities""",
        "cycle_log": f"""WITH {TRADES}, {SEEN},
            windows AS (
              SELECT w AS window_id,
                     TIMESTAMP '2024-01-01 00:00:00.7' + to_minutes(5 * w) AS from_ts,
                     CASE WHEN w = last THEN TIMESTAMP '2024-01-30 23:59:58.9'
                          ELSE TIMESTAMP '2024-01-01 00:00:00.7' + to_minutes(5 * w + 5)
                     END AS till_ts
              FROM (SELECT last, unnest(generate_series(0, last)) AS w FROM (SELECT
                {WHOLE_WINDOWS.format(now="TIMESTAMP '2024-01-30 23:59:58.9'",
                                      start="TIMESTAMP '2024-01-01 00:00:00.7'")}
                AS last))),
            minutes AS (
              SELECT secid, tradeno, date_trunc('minute', trade_ts) AS m FROM trades),
            fetched AS (
              SELECT window_id, secid, tradeno
              FROM minutes JOIN windows
                ON m >= date_trunc('second', from_ts)
               AND m <= date_trunc('second', till_ts)),
            firsts AS (
              SELECT f.window_id,
                     min(f.window_id) OVER (PARTITION BY f.secid, f.tradeno)
                       = f.window_id AND s.tradeno IS NULL AS fresh
              FROM fetched f LEFT JOIN seen s
                ON s.secid = f.secid AND s.tradeno = f.tradeno)
            SELECT w.window_id, w.from_ts, w.till_ts,
                   count(*) FILTER (fresh) AS collected,
                   count(*) FILTER (NOT fresh) AS duplicates,
                   count(f.window_id) // 2 + 1 AS api_calls
            FROM windows w LEFT JOIN firsts f ON f.window_id = w.window_id
            GROUP BY 1, 2, 3""",
        "metrics_totals": f"""WITH {TRADES}, {CYCLES}
            SELECT run_id, {TOTAL_COLUMNS} FROM cycles GROUP BY run_id""",
        "metrics_running": f"""WITH {TRADES}, {CYCLES}
            SELECT run_id, cycle,
                   CAST(sum(CASE WHEN status = 'ok' THEN collected ELSE 0 END) OVER w
                        AS BIGINT) AS total_trades_collected,
                   CAST(sum(CASE WHEN status = 'ok' THEN 1 ELSE 0 END) OVER w
                        AS BIGINT) AS total_cycles_completed
            FROM cycles WINDOW w AS (PARTITION BY run_id ORDER BY cycle)""",
        "metrics_avg": f"""WITH {TRADES}, {CYCLES}
            SELECT run_id,
                   CASE WHEN count(*) FILTER (status = 'ok') > 0
                        THEN CAST(sum(collected) FILTER (status = 'ok') AS DOUBLE)
                             / count(*) FILTER (status = 'ok')
                        ELSE 0.0 END AS avg_trades_per_cycle
            FROM cycles GROUP BY run_id""",
        "last_cycle": f"""WITH {TRADES}, {CYCLES}
            SELECT run_id,
                   CAST(coalesce(floor((epoch_us(max(ended) FILTER (status = 'ok'))
                        - epoch_us(max(started))) / 1000.0), 0) AS BIGINT)
                     AS last_cycle_duration_ms,
                   {UPTIME}
            FROM cycles GROUP BY run_id""",
        "error_count": f"""WITH {TRADES}, {CYCLES}
            SELECT run_id, count(*) FILTER (status = 'error') AS total_errors
            FROM cycles GROUP BY run_id""",
        "seen_counts": f"""WITH {LINES}
            SELECT secid, count(*) AS held FROM ({TOP_SEEN}) GROUP BY secid""",
        "collector_status": f"""WITH {TRADES}, {CYCLES}
            SELECT run_id, true AS enabled, 'SPECIFIC' AS mode,
                   'click,purchase' AS configured_tickers,
                   bool_or(status = 'ok' AND kind = 'initial') AS initial_load_complete,
                   {LAST_TRADE_TIME},
                   CAST(coalesce(sum(collected) FILTER (status = 'ok'), 0) AS BIGINT)
                     AS total_trades_collected,
                   count(*) FILTER (status = 'ok') AS total_cycles_completed,
                   CAST(coalesce(sum(api_calls) FILTER (status = 'ok'), 0) AS BIGINT)
                     AS total_api_calls,
                   count(*) FILTER (status <> 'ok') AS total_errors,
                   {UPTIME}
            FROM cycles GROUP BY run_id""",
        "bounded_seen_set": f"WITH {LINES} {TOP_SEEN}",
        "mark_batch": f"""WITH {LINES}, ranked AS (
              SELECT secid, tradeno,
                     row_number() OVER (PARTITION BY secid ORDER BY tradeno DESC) AS r
              FROM (SELECT DISTINCT secid, tradeno FROM lines
                    WHERE trade_ts <= TIMESTAMP '1996-01-01 00:00:00')),
            merged AS (
              SELECT secid, tradeno FROM ranked WHERE r <= 10000
              UNION
              SELECT secid, tradeno FROM lines
              WHERE trade_ts > TIMESTAMP '1996-01-01 00:00:00')
            SELECT secid, tradeno FROM (
              SELECT *, row_number() OVER (PARTITION BY secid ORDER BY tradeno DESC) AS r
              FROM merged)
            WHERE r <= 10000""",
        "mark_bitmaps": f"WITH {LINES} SELECT DISTINCT secid, tradeno FROM lines",
        "bitmap_counts": f"""WITH {LINES}
            SELECT secid, count(DISTINCT tradeno) AS held FROM lines GROUP BY secid""",
        "cursor_state": f"""WITH {TRADES}, {CYCLES}
            SELECT run_id, {CURSOR_COLUMNS} FROM cycles GROUP BY run_id""",
        "cursor_advance": f"""WITH {TRADES}, {CYCLES}, state AS (
              SELECT run_id, {CURSOR_COLUMNS} FROM cycles GROUP BY run_id)
            SELECT run_id, TIMESTAMP '2024-02-01 08:15:30.25' AS last_trade_time,
                   initial_load_complete, total_trades_collected,
                   total_cycles_completed,
                   TIMESTAMP '2024-02-01 08:15:30.25' AS last_update_time
            FROM state""",
        "cursor_totals": f"""WITH {TRADES}, {CYCLES}, state AS (
              SELECT run_id, {CURSOR_COLUMNS} FROM cycles GROUP BY run_id)
            SELECT run_id, total_trades_collected, total_cycles_completed
            FROM state""",
        "initial_load": f"""WITH {TRADES}
            SELECT {LOADED} FROM trades WHERE {RANGE} AND {SYMBOLS}""",
        "incremental_load": f"""WITH {TRADES}, {SEEN}
            SELECT {LOADED} FROM trades t WHERE {RANGE} AND {SYMBOLS}
              AND NOT EXISTS (SELECT 1 FROM seen s
                              WHERE s.secid = t.secid AND s.tradeno = t.tradeno)""",
        "collector_cycles": f"""WITH {TRADES}, bounds AS (
              SELECT 0 AS cycle, 'initial' AS kind, TIMESTAMP '2024-01-01' AS start,
                     TIMESTAMP '2024-01-01' AS till, TIMESTAMP '2024-01-01' AS now
              UNION ALL SELECT w, 'incremental', TIMESTAMP '2024-01-01' + to_days(5 * w - 5),
                     TIMESTAMP '2024-01-01' + to_days(5 * w), TIMESTAMP '2024-01-31'
              FROM (SELECT CAST(unnest(generate_series(1, 6)) AS INTEGER) AS w)),
            fetched AS (
              SELECT bounds.*, tradeno, cycle = 0 OR trade_ts > start AS fresh
              FROM bounds LEFT JOIN trades ON trade_ts BETWEEN start AND till)
            SELECT 'collector' AS run_id, CAST(cycle AS BIGINT) AS cycle, kind,
                   now AS started, now AS ended, till,
                   count(tradeno) FILTER (fresh) AS collected,
                   count(tradeno) FILTER (NOT fresh) AS duplicates,
                   count(tradeno) // 5000 + 1 AS api_calls, 'ok' AS status,
                   count(tradeno) FILTER (fresh) AS sent,
                   CAST(coalesce(sum(tradeno) FILTER (fresh), 0) AS BIGINT) AS sum_tradeno
            FROM fetched GROUP BY cycle, kind, now, till""",
        "collector_restart": f"""WITH {TRADES}
            SELECT secid || ':' || tradeno AS key, CAST(2 AS BIGINT) AS copies
            FROM trades
            WHERE trade_ts BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-31'""",
        "catchup_windows": f"""WITH {TRADES}, bounds AS (
              SELECT secid,
                     max(trade_ts) FILTER (
                       trade_ts <= TIMESTAMP '2024-01-12 06:00:00') AS a,
                     max(trade_ts) AS b
              FROM trades GROUP BY secid),
            spans AS (
              SELECT *, {WHOLE_WINDOWS.format(now="b", start="a")} AS last FROM bounds),
            numbered AS (
              SELECT *, unnest(generate_series(0, last)) AS w FROM spans)
            SELECT secid, w AS window_id, a + to_minutes(5 * w) AS from_ts,
                   CASE WHEN w = last THEN b ELSE a + to_minutes(5 * w + 5) END
                     AS till_ts
            FROM numbered""",
        "sink_trades": f"""WITH {TRADES}, {MESSAGES}
            SELECT key, value, "partition", CAST(0 AS BIGINT) AS batch_id,
                   'trades' AS topic
            FROM messages""",
        "sink_securities": f"""WITH {SECURITIES}
            SELECT secid AS key, {SECURITY_MESSAGE} AS value,
                   CAST(0 AS INTEGER) AS "partition", CAST(0 AS BIGINT) AS batch_id,
                   'instruments' AS topic
            FROM securities""",
        "stream_incremental": f"""WITH {LINES}
            SELECT {LOADED} FROM (
              SELECT *, row_number() OVER (
                PARTITION BY secid, tradeno
                ORDER BY trade_ts, tradetime, boardid, price, quantity, value) AS r
              FROM lines)
            WHERE r = 1""",
        "stream_watermark": f"WITH {LINES} SELECT DISTINCT secid, tradeno FROM lines",
    }
