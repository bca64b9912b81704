"""Order-insensitive comparison of a Spark frame with a DuckDB statement."""

from __future__ import annotations

import datetime
import decimal
import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels"
    " conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        return format(value.normalize(), "f") if value else "0"
    if isinstance(value, bool) or value is None:
        return str(value)
    if isinstance(value, float):
        return "NaN" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.datetime):
        return "ts:" + value.isoformat()
    if isinstance(value, (list, tuple)):
        return "[" + ",".join(plain(v) for v in value) + "]"
    return str(value)


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in rows)


def differences(frame, con, sql: str) -> list[str]:
    """Empty when names, row count and values agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = rows_of(names, result.fetchall())
    actual = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if sorted(names) != sorted(frame.columns):
        return [f"columns: spark {sorted(frame.columns)} sql {sorted(names)}"]
    problems = []
    if len(actual) != len(expected):
        problems.append(f"rows: spark {len(actual)} sql {len(expected)}")
    if actual != expected:
        left, right = set(actual), set(expected)
        problems += [f"only spark: {r}" for r in sorted(left - right)[:3]]
        problems += [f"only sql:   {r}" for r in sorted(right - left)[:3]]
        problems = problems or ["row multiplicities differ"]
        problems.append("columns: " + ",".join(sorted(names)))
    return problems
