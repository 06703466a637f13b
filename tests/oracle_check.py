"""Run a registered Spark query and its DuckDB twin and compare them.

Mirrors the driver's gate: same column names, same row count, and the same
order-insensitive multiset of rows (doubles rounded to 6 places).
"""

from __future__ import annotations

import math

import duckdb

from wordmill.session import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return round(v, 6) + 0.0
    if isinstance(v, bool):
        return v
    if isinstance(v, int):
        return v
    if hasattr(v, "item"):
        return _norm(v.item())
    return str(v)


def compare(spark, con, sf_dir: str, name: str, query, sql: str) -> tuple[bool, str]:
    sdf = query(spark, sf_dir)
    s_cols = list(sdf.columns)
    s_rows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(sql)
    d_cols = [c[0] for c in cur.description]
    d_rows = cur.fetchall()
    if sorted(s_cols) != sorted(d_cols):
        return False, f"{name}: columns differ {sorted(s_cols)} vs {sorted(d_cols)}"
    order = sorted(range(len(s_cols)), key=lambda i: s_cols[i])
    d_index = {c: i for i, c in enumerate(d_cols)}
    sk = sorted((tuple(_norm(r[i]) for i in order) for r in s_rows), key=repr)
    dk = sorted((tuple(_norm(r[d_index[s_cols[i]]]) for i in order) for r in d_rows), key=repr)
    if len(sk) != len(dk):
        return False, f"{name}: rows {len(sk)} vs {len(dk)}"
    for a, b in zip(sk, dk):
        if a != b:
            return False, f"{name}: first differing row\n spark={a!r}\n duck ={b!r}"
    return True, f"{name}: {len(sk)} rows equal"
