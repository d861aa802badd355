"""Compare a Spark result with a DuckDB result: column names, rows and values."""

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET timezone = 'UTC'")
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        source = f"{p}/*.parquet" if os.path.isdir(p) else p
        con.execute(f"CREATE VIEW {os.path.basename(p)[:-8]} AS SELECT * FROM '{source}'")
    return con


def _plain(v):
    if v is None or v is pd.NA or v is pd.NaT or (isinstance(v, float) and v != v):
        return "NULL"
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, (int, float)):
        return str(float(v))
    return v if isinstance(v, str) else repr(v.tolist() if hasattr(v, "tolist") else v)


def rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    return sorted(tuple(_plain(v) for v in r) for r in df.astype(object).itertuples(index=False))


def same(left: pd.DataFrame, right: pd.DataFrame) -> None:
    assert sorted(left.columns) == sorted(right.columns)
    a, b = rows(left), rows(right)
    assert len(a) == len(b), (len(a), len(b))
    different = [(x, y) for x, y in zip(a, b, strict=True) if x != y]
    assert not different, different[:3]
