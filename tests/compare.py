"""Comparing a query with its DuckDB counterpart."""

import glob
import os

import duckdb
import pandas as pd


def _rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)]

    def text(x):
        if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
            return "NULL"
        return f"{x:.9g}" if isinstance(x, float) else str(x)

    return sorted(tuple(map(text, r)) for r in df.itertuples(index=False))


def same_rows(df, sql: str | None, folder: str) -> None:
    mine = df.toPandas()
    if sql is None:
        return
    con = duckdb.connect()
    con.execute("set TimeZone = 'UTC'")
    for f in glob.glob(f"{folder}/*.parquet"):
        con.execute(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    other = con.execute(sql).df()
    assert sorted(mine.columns) == sorted(other.columns)
    assert _rows(mine) == _rows(other)
