"""Runs queries against their SQL on the smallest tables."""

from __future__ import annotations

import datetime
import decimal
from collections import Counter
from pathlib import Path

import duckdb

DATA = Path("/root/testdata/sf0.001")


def plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, decimal.Decimal):
        return round(float(value), 6)
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    return value.isoformat() if isinstance(value, (datetime.date, datetime.datetime)) else value


def duck():
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for path in DATA.glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def same(spark, query, sql: str) -> int:
    """Asserts that both give the same columns and rows; the number of rows."""
    df = query(spark, str(DATA))
    columns = sorted(df.columns)
    found = Counter(repr(tuple(plain(r[c]) for c in columns)) for r in df.collect())
    result = duck().execute(sql)
    names = [d[0] for d in result.description]
    assert sorted(names) == columns
    wanted = Counter(repr(tuple(plain(r[names.index(c)]) for c in columns)) for r in result.fetchall())
    assert found == wanted, ((found - wanted).most_common(3), (wanted - found).most_common(3))
    return sum(found.values())
