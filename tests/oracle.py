"""Comparison of a registered query with its SQL in DuckDB."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else repr(value)
    if isinstance(value, bool):
        return value
    if isinstance(value, (int, decimal.Decimal)):
        return repr(float(value)) if isinstance(value, decimal.Decimal) else value
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value if isinstance(value, str) else str(value)


def spark_rows(df):
    columns = sorted(df.columns)
    return columns, Counter(tuple(plain(r[c]) for c in columns) for r in df.collect())


def sql_rows(con, sql: str):
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    columns = sorted(names)
    place = [names.index(c) for c in columns]
    return columns, Counter(tuple(plain(r[i]) for i in place) for r in result.fetchall())
