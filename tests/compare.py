"""Run a registered query and its SQL side by side and compare the rows."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        path = os.path.join(sf_dir, f"{table}.parquet")
        if os.path.exists(path):
            con.execute(f"create view {table} as select * from '{path}'")
    return con


def _key(row):
    return tuple((v is None, str(type(v)), v if v is not None else 0) for v in row)


def normal(rows, columns):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted([tuple(row[k] for k in order) for row in rows], key=_key)


def mismatch(df, con, sql: str) -> str | None:
    """None when rows, columns and values agree, else a short description."""
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    want_columns = [d[0] for d in cur.description]
    want = cur.fetchall()
    if sorted(df.columns) != sorted(want_columns):
        return f"columns {sorted(df.columns)} != {sorted(want_columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    for a, b in zip(normal(got, df.columns), normal(want, want_columns)):
        for x, y in zip(a, b):
            if type(x) is not type(y) or (x != y and not (isinstance(x, float) and math.isnan(x) and math.isnan(y))):
                return f"{a} != {b}"
    return None
