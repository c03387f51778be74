"""Comparing a Spark result with a DuckDB result: same columns, same rows in any order."""

from __future__ import annotations

import math
import os

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if isinstance(v, bool):
        return v
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9) + 0.0
    if hasattr(v, "as_tuple"):
        return ("decimal", str(v))
    return v


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(columns), sorted(out, key=lambda r: tuple((x is None, str(type(x)), str(x)) for x in r))


def spark_rows(df):
    return _sorted_rows(df.columns, [tuple(r) for r in df.collect()])


def duck_rows(con, sql):
    rel = con.sql(sql)
    return _sorted_rows(list(rel.columns), rel.fetchall())


def differences(df, con, sql, limit=3):
    """Empty when equal, else a short account."""
    sc, sr = spark_rows(df)
    dc, dr = duck_rows(con, sql)
    if sc != dc:
        return [f"columns {sc} against {dc}"]
    if len(sr) != len(dr):
        return [f"rows {len(sr)} against {len(dr)}"]
    return [f"{a!r:.300} against {b!r:.300}" for a, b in zip(sr, dr) if a != b][:limit]
