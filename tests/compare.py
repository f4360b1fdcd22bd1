"""Compare a query with its SQL counterpart, independent of row order."""

from __future__ import annotations

import datetime as dt
import math
import os
from decimal import Decimal

import duckdb


def oracle_connection(directory: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in sorted(os.listdir(directory)):
        name = file.removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{directory}/{file}')")
    return con


def plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.9g}"
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, bool) or value is None:
        return repr(value)
    return str(value)


def as_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN",
    "date": "DATE", "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def difference(df, con, sql: str) -> str | None:
    """None when both agree, else what differs."""
    result = con.execute(sql)
    types = {d[0]: str(d[1]) for d in result.description}
    expected = result.fetchall()
    columns = list(types)
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    wrong = [f"{n}: {t} != {types[n]}" for n, t in df.dtypes if KINDS.get(t, t) != types[n]]
    actual = [tuple(r) for r in df.collect()]
    if len(actual) != len(expected):
        return f"{len(actual)} rows != {len(expected)}"
    a, b = as_rows(df.columns, actual), as_rows(columns, expected)
    if a != b:
        pairs = [(x, y) for x, y in zip(a, b) if x != y]
        return f"{len(pairs)} rows differ, first {pairs[0]}"
    return "types " + ", ".join(wrong) if wrong else None
