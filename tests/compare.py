"""Run a registered query and its SQL on the same tables and compare them."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return f"{type(value).__name__}:{value}" if value is not None else None


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql) -> str | None:
    """None when both sides hold the same rows, else a short description."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(set(df.columns) ^ set(names))}"
    expected = _bag(names, result.fetchall())
    actual = _bag(df.columns, [tuple(r) for r in df.collect()])
    if actual == expected:
        return None
    missing, extra = expected - actual, actual - expected
    text = f"missing {sum(missing.values())}, extra {sum(extra.values())}"
    if missing and extra:
        keys = sorted(names)
        want = next(iter(missing))
        got = min(extra, key=lambda r: sum(a != b for a, b in zip(r, want)))
        diff = [(k, a, b) for k, a, b in zip(keys, want, got) if a != b]
        text += f"; nearest pair (column, expected, actual): {diff[:6]}"
    return text
