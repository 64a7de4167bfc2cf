"""Rows of a Spark frame and of DuckDB SQL in one comparable form."""

import os

import duckdb
import pandas as pd


def plain(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and x != x):
        return None
    if isinstance(x, (list, tuple)) or (hasattr(x, "tolist") and hasattr(x, "__len__")):
        return tuple(plain(y) for y in x)
    if isinstance(x, dict):
        return tuple(sorted((k, plain(v)) for k, v in x.items()))
    if hasattr(x, "item") and not hasattr(x, "__len__"):
        x = x.item()
    if isinstance(x, float):
        return int(x) if abs(x) < 2**62 and x == int(x) else round(x, 6)
    return x


def rows(df: pd.DataFrame) -> list:
    return sorted((tuple(plain(x) for x in r) for r in df[sorted(df.columns)].itertuples(index=False, name=None)), key=repr)


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for name in os.listdir(folder):
        con.sql(f"CREATE VIEW {name.removesuffix('.parquet')} AS SELECT * FROM '{folder}/{name}'")
    return con
