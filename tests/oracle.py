"""Compare a Spark result with what DuckDB gives for the same tables: equal columns, equal rows in any order."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

from quayline.checks.queries import GENERIC


def duck(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in GENERIC:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{folder}/{name}.parquet')")
    return connection


def plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value


def rows_of(columns, rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(r[i]) for i in order) for r in rows), key=repr)


def differences(df, connection, sql: str) -> str | None:
    """What differs, or None."""
    answer = connection.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(set(names) ^ set(df.columns))}"
    expected, found = rows_of(names, answer.fetchall()), rows_of(df.columns, df.collect())
    if len(expected) != len(found):
        return f"{len(found)} rows instead of {len(expected)}"
    for e, f in zip(expected, found):
        if e != f:
            bad = [(c, x, y) for c, x, y in zip(sorted(names), e, f) if x != y or type(x) is not type(y)]
            return f"expected != found: {bad[:6]}"
    return None
