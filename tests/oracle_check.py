"""Compare a registered query with its oracle as multisets of rows."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def _cell(v):
    if v is None or v is pd.NaT or (isinstance(v, float) and v != v):
        return "NULL"
    if isinstance(v, float):
        return repr(v)
    return str(v)


def rows(names: list[str], data) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in data)


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str:
    """'' if equal, otherwise what differs."""
    df = query(spark, sf_dir)
    got = rows(df.columns, df.collect())
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows(names, res.fetchall())
    if sorted(names) != sorted(df.columns):
        return f"{name}: columns {sorted(df.columns)} != {sorted(names)}"
    if got != want:
        gs, ws = set(got), set(want)
        return (f"{name}: {len(got)} rows vs {len(want)}; only here {sorted(gs - ws)[:3]}; "
                f"only oracle {sorted(ws - gs)[:3]}")
    return ""
