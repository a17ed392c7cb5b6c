"""Compares a Spark result with DuckDB's, row by row and bit by bit."""

import glob
import os

import duckdb
import pandas as pd


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _rows(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for name in frame:
        if pd.api.types.is_datetime64_any_dtype(frame[name]):
            frame[name] = frame[name].astype("datetime64[us]").astype("int64")
        elif pd.api.types.is_numeric_dtype(frame[name]):
            frame[name] = frame[name].astype("float64")
    return frame.sort_values(list(frame.columns), ignore_index=True)


def differences(spark_result: pd.DataFrame, sql_result: pd.DataFrame) -> str | None:
    left, right = _rows(spark_result), _rows(sql_result)
    if list(left.columns) != list(right.columns):
        return f"columns {list(left.columns)} and {list(right.columns)}"
    if len(left) != len(right):
        return f"{len(left)} and {len(right)} rows"
    for name in left:
        same = (left[name] == right[name]) | (left[name].isna() & right[name].isna())
        if not same.all():
            row = same.idxmin()
            return f"{name}: {(~same).sum()} rows differ, first {left.loc[row].to_dict()} and {right.loc[row].to_dict()}"
    return None
