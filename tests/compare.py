"""Compare a Spark result with SQL run by DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter
from datetime import datetime
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf}/{name}.parquet')")
    return con


def normal(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int, Decimal)):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 6)
    if isinstance(value, datetime):
        return value.replace(tzinfo=None).isoformat()
    if isinstance(value, (bytes, bytearray)):
        return bytes(value)
    return value


def multiset(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(normal(r[i]) for i in order) for r in rows)


def compare(spark_frame, con, sql) -> tuple[int, int]:
    """Rows on both sides; raises AssertionError where they differ."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = multiset(names, cursor.fetchall())
    actual = multiset(spark_frame.columns, [tuple(r) for r in spark_frame.collect()])
    assert sorted(spark_frame.columns) == sorted(names), (sorted(spark_frame.columns), sorted(names))
    if actual != expected:
        extra, lost = actual - expected, expected - actual
        raise AssertionError(
            f"{sum(extra.values())} rows too many, {sum(lost.values())} missing; "
            f"e.g. got {list(extra)[:2]} wanted {list(lost)[:2]}"
        )
    return sum(actual.values()), sum(expected.values())
