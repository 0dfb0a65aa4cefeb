"""Comparison of query results with the oracle engine, and small helpers."""

from __future__ import annotations

import datetime
import decimal
import numbers
import os

import duckdb
import pandas as pd

DATA = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def plain(x) -> str:
    if x is None or x is pd.NaT or x is pd.NA:
        return "NULL"
    if isinstance(x, bool) or type(x).__name__ == "bool_":
        return str(bool(x))
    if isinstance(x, numbers.Integral):
        return str(int(x))
    if isinstance(x, (numbers.Real, decimal.Decimal)):
        x = float(x)
        return "NULL" if x != x else str(int(x)) if x == int(x) else f"{x:.6g}"
    if isinstance(x, datetime.datetime):
        return str(x)[:10] if (x.hour, x.minute, x.second, x.microsecond) == (0, 0, 0, 0) else str(x)
    return str(x)


def normalised(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    return sorted(tuple(map(plain, row)) for row in df[cols].itertuples(index=False, name=None))


def oracle(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for f in os.listdir(folder):
        if f.endswith(".parquet"):
            con.execute(f"CREATE VIEW {f[:-8]} AS SELECT * FROM read_parquet('{folder}/{f}')")
    return con


def check(registry, name: str, spark, con) -> None:
    got, want = registry.queries[name](spark, DATA).toPandas(), con.execute(registry.oracles[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert normalised(got) == normalised(want)


def tuples(df) -> list[tuple]:
    return sorted((tuple(r) for r in df.collect()), key=repr)
