"""Row-for-row comparison of a Spark result with DuckDB over the same tables."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, Decimal):
        return float(f"{float(value):.9g}")
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, bool) or value is None:
        return value
    return value


_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp",
}


def differences(result, sql: str, con: duckdb.DuckDBPyConnection) -> list[str]:
    """What differs between a Spark DataFrame and the SQL's result; empty when they agree."""
    columns = sorted(result.columns)
    types = dict(result.dtypes)
    described = con.execute(f"DESCRIBE {sql}").fetchall()
    expected_types = {row[0]: _TYPES.get(row[1], row[1]) for row in described}
    problems = []
    if columns != sorted(expected_types):
        return [f"columns {sorted(set(columns) ^ set(expected_types))}"]
    for c in columns:
        if types[c] != expected_types[c]:
            problems.append(f"type of {c}: {types[c]} / {expected_types[c]}")
    listed = ", ".join(f'"{c}"' for c in columns)
    expected = con.execute(f"SELECT {listed} FROM ({sql}) AS q").fetchall()
    actual = result.select(*columns).collect()
    left = Counter(tuple(plain(v) for v in row) for row in actual)
    right = Counter(tuple(plain(v) for v in row) for row in expected)
    if left != right:
        problems.append(f"rows {len(actual)} / {len(expected)}")
        problems += [f"only spark {r}" for r in list((left - right).keys())[:3]]
        problems += [f"only duckdb {r}" for r in list((right - left).keys())[:3]]
        if left - right and right - left:
            a, b = sorted((left - right), key=repr)[0], sorted((right - left), key=repr)[0]
            problems.append(str([(c, x, y) for c, x, y in zip(columns, a, b) if x != y]))
    return problems
