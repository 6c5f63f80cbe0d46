"""Runs registered queries next to their SQL and compares the rows as multisets."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        path = Path(sf_dir) / f"{name}.parquet"
        if path.exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return rows_of(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    result = con.execute(sql)
    return rows_of([d[0] for d in result.description], result.fetchall())


def difference(df, con, sql) -> str | None:
    """None when both agree exactly, else what differs."""
    names, ours = spark_rows(df)
    expected_names, theirs = duck_rows(con, sql)
    if names != expected_names:
        return f"columns {names} != {expected_names}"
    if ours == theirs:
        return None
    only_ours, only_theirs = list((ours - theirs).elements()), list((theirs - ours).elements())
    key = lambda r: tuple(str(v) for v in r)
    return (
        f"{sum(ours.values())} rows vs {sum(theirs.values())}, {len(only_ours)} differ; "
        f"columns {names}\n  ours   {sorted(only_ours, key=key)[:2]}\n  theirs {sorted(only_theirs, key=key)[:2]}"
    )
