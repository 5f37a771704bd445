"""Runs a catalog entry and its SQL, and compares rows regardless of order."""

from __future__ import annotations

import glob
import os
from collections import Counter
from datetime import date, datetime
from decimal import Decimal

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float):
        return float(f"{value:.12g}")
    if isinstance(value, (datetime, date)):
        return value.isoformat()
    return value


def rows_of(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def spark_rows(df) -> tuple[list[str], Counter]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def sql_rows(con, sql: str) -> tuple[list[str], Counter]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), rows_of(names, result.fetchall())


KINDS = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "VARCHAR": "string",
    "DOUBLE": "double",
    "BOOLEAN": "boolean",
    "TIMESTAMP": "timestamp_ntz",
}


def spark_types(df) -> dict[str, str]:
    return dict(df.dtypes)


def sql_types(con, sql: str) -> dict[str, str]:
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    return {name: KINDS.get(kind, kind) for name, kind, *_ in described}
