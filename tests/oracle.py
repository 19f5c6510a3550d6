"""Compare registered queries with their SQL on the given tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb

SF = os.environ.get("QF_SF_DIR", "/root/testdata/sf0.01")


def connect(base: str = SF) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for p in glob.glob(f"{base}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{p}'")
    return con


def _norm(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "NaN"
        return 0.0 if v == 0 else v
    return v


def _sorted(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted([tuple(_norm(r[i]) for i in order) for r in rows], key=repr)


def compare(name: str, df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    got = [tuple(r) for r in df.collect()]
    res = con.execute(sql)
    want_cols = [d[0] for d in res.description]
    want = res.fetchall()
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    a, b = _sorted(df.columns, got), _sorted(want_cols, want)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    bad = [(x, y) for x, y in zip(a, b) if x != y]
    if bad:
        return f"{len(bad)} of {len(a)} rows differ, e.g. {bad[:2]}"
    kinds = {(type(x).__name__, type(y).__name__) for r, s in zip(a, b) for x, y in zip(r, s) if x is not None}
    odd = {k for k in kinds if k[0] != k[1]}
    return f"types {odd}" if odd else None
