"""Compare a registered query with its SQL statement on the same Parquet tables."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter
from decimal import Decimal

import duckdb
import pandas as pd


def connect(folder: str):
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{folder}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(v):
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v + 0.0
    if isinstance(v, Decimal):
        return v.normalize()
    return v


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


def compare(df, con, sql: str) -> str | None:
    """None if both give the same rows, else a description of the difference."""
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = rows_of(names, cur.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns differ: {sorted(df.columns)} / {sorted(names)}"
    if got == want:
        return None
    only_got, only_want = list((got - want).elements()), list((want - got).elements())
    return (
        f"{sum(got.values())} rows against {sum(want.values())}; "
        f"{len(only_got)} differ, e.g. {sorted(only_got, key=str)[:2]} "
        f"against {sorted(only_want, key=str)[:2]} of {sorted(names)}"
    )
