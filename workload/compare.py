"""Order-insensitive comparison of a query with its SQL, as the driver does it."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value: object) -> object:
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(item) for item in value)
    return value


def _table(columns: list[str], rows: list) -> tuple[list[str], Counter]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    counted = Counter(tuple((type(row[i]).__name__, _plain(row[i])) for i in order) for row in rows)
    return [columns[i] for i in order], counted


def same(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> tuple[bool, str]:
    """Whether both give the same columns and rows, value types included."""
    result = con.execute(sql)
    want = _table([d[0] for d in result.description], result.fetchall())
    got = _table(df.columns, [tuple(row) for row in df.collect()])
    if got[0] != want[0]:
        return False, f"columns {got[0]} against {want[0]}"
    if got[1] == want[1]:
        return True, f"{sum(got[1].values())} rows"
    extra, lacking = got[1] - want[1], want[1] - got[1]
    return False, f"only in Spark: {list(extra)[:2]}; only in SQL: {list(lacking)[:2]}"
