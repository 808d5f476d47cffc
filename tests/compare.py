"""Run queries on Spark and their oracle on DuckDB, and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb


def connect(root: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(root).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value: object) -> object:
    """One spelling per value. Types are kept apart, so that 1 and 1.0 do not pass as equal."""
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else ("f", 0.0 if value == 0 else value)
    if isinstance(value, decimal.Decimal):
        return ("d", str(value))
    if isinstance(value, dt.datetime):
        return value.isoformat()
    return value


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in data), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows(df.columns, df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    return sorted(names), rows(names, result.fetchall())


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    s_cols, s = spark_rows(df)
    d_cols, d = duck_rows(con, sql)
    if s_cols != d_cols:
        return f"columns {s_cols} against {d_cols}"
    if len(s) != len(d):
        return f"{len(s)} rows against {len(d)}"
    bad = [(a, b) for a, b in zip(s, d) if a != b]
    if bad:
        return f"{len(bad)} of {len(s)} rows differ in {s_cols}, first {bad[0][0]} against {bad[0][1]}"
    return None
