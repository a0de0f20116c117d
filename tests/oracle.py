"""Runs a registered query and its expected SQL, and compares the two row multisets."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(r[i]) for i in order) for r in rows), key=repr)


def compare(spark, con, query, sf_dir: str) -> str | None:
    """None when equal, else a short description of the difference."""
    frame = query.build(spark, sf_dir)
    actual = rows_of(frame.columns, [tuple(r) for r in frame.collect()])
    if query.expected is None:
        return None if actual else "no rows"
    cursor = con.execute(query.expected)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    if sorted(names) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} != {sorted(names)}"
    if actual == expected:
        kinds = {c: type(v).__name__ for c, v in zip(sorted(names), expected[0])} if expected else {}
        got = {c: type(v).__name__ for c, v in zip(sorted(names), actual[0])} if actual else {}
        return None if kinds == got else f"types {got} != {kinds}"
    a, b = set(actual), set(expected)
    return f"rows {len(actual)} vs {len(expected)}; only actual {sorted(a - b, key=repr)[:2]}; only expected {sorted(b - a, key=repr)[:2]}"
