"""Spark result against the SQL result on the same files."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    return v


def as_rows(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, con, sql: str) -> str | None:
    """None if both give the same columns and rows, else what differs first."""
    cur = con.execute(sql)
    want_cols = [d[0] for d in cur.description]
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    want = as_rows(want_cols, cur.fetchall())
    got = as_rows(df.columns, [tuple(r) for r in df.collect()])
    if got == want:
        return None
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; "
        f"only Spark: {list((got - want).items())[:2]}; only SQL: {list((want - got).items())[:2]}"
    )
