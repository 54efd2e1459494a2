"""Compare a query's rows with its SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(folder: str):
    con = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, float, Decimal)):
        number = float(value)
        return "nan" if math.isnan(number) else round(number, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    want_columns, want = _rows(names, result.fetchall())
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got_columns != want_columns:
        return f"columns {got_columns} instead of {want_columns}"
    if got != want:
        return f"{sum(got.values())} rows for {sum(want.values())}; extra {list((got - want).items())[:3]}, missing {list((want - got).items())[:3]}"
    return None
