"""Compare a query's rows with its SQL in DuckDB."""

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir):
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"create view {os.path.basename(p)[:-8]} as select * from '{p}'")
    return c


def plain(v):
    if v is None or v is pd.NA or isinstance(v, float) and v != v:
        return "null"
    if isinstance(v, float):
        return f"{v:.9g}"
    if hasattr(v, "tolist"):
        v = v.tolist()
    if isinstance(v, list):
        return str([plain(x) for x in v])
    return str(v)


def rows_of(df: pd.DataFrame):
    cols = sorted(df.columns)
    return cols, sorted(tuple(plain(v) for v in r) for r in df[cols].itertuples(index=False))


def differences(spark, con, query, sql, sf_dir):
    got, want = rows_of(query(spark, sf_dir).toPandas()), rows_of(con.execute(sql).df())
    if got[0] != want[0]:
        return f"columns {got[0]} and {want[0]}"
    if got[1] != want[1]:
        a, b = set(got[1]), set(want[1])
        return f"{len(got[1])} and {len(want[1])} rows; only here {list(a - b)[:2]}; only there {list(b - a)[:2]}"
    return ""
