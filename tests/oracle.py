"""Compares a query with its SQL, row by row, whatever the order."""

from __future__ import annotations

import datetime
import decimal
import math
import os
from collections import Counter


def duck(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in sorted(os.listdir(sf_dir)):
        if name.endswith(".parquet"):
            path = os.path.join(sf_dir, name)
            path = f"{path}/*.parquet" if os.path.isdir(path) else path
            con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{path}')")
    return con


def plain(v):
    if v is None or (isinstance(v, float) and math.isnan(v)):
        return None
    if isinstance(v, bool):
        return v
    if isinstance(v, decimal.Decimal):
        return float(v)
    if isinstance(v, float):
        return float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (datetime.date,)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(plain(x) for x in v)
    if hasattr(v, "item"):
        return plain(v.item())
    return v


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(r[i]) for i in order) for r in rows)


def compare(spark, query, sql: str, sf_dir: str) -> str:
    """'' if both give the same rows, else what differs."""
    df = query(spark, sf_dir)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    rel = duck(sf_dir).execute(sql)
    names = [d[0] for d in rel.description]
    want = rows_of(names, rel.fetchall())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if got == want:
        return ""
    return f"rows {sum(got.values())} vs {sum(want.values())}; only spark {list((got - want).items())[:3]}; only sql {list((want - got).items())[:3]}"
