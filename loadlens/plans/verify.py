"""Compare a Spark result with its DuckDB oracle (columns, row count, sorted values)."""

from __future__ import annotations

import math


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    return v


def _key(row):
    return tuple((x is None, type(x).__name__, x if x is not None else 0) for x in row)


def duckdb_connection(sf_dir: str):
    import duckdb

    from loadlens.sources.tables import TABLES

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def compare(df, con, sql: str) -> tuple[bool, str, int]:
    """Returns (equal, message, spark row count).  Rows are collected: small scales only."""
    cols = df.columns
    srows = [tuple(_norm(x) for x in r) for r in df.collect()]
    rel = con.sql(sql)
    dcols = rel.columns
    if sorted(cols) != sorted(dcols):
        return False, f"columns differ: spark={cols} duckdb={dcols}", len(srows)
    idx = [dcols.index(c) for c in cols]
    drows = [tuple(_norm(r[i]) for i in idx) for r in rel.fetchall()]
    if len(srows) != len(drows):
        return False, f"rows spark={len(srows)} duckdb={len(drows)}", len(srows)
    srows.sort(key=_key)
    drows.sort(key=_key)
    diff = [(a, b) for a, b in zip(srows, drows) if a != b]
    if diff:
        return False, f"{len(diff)} rows differ, e.g. {diff[:2]}", len(srows)
    return True, "", len(srows)
