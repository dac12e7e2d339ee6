"""Run a query on Spark and its SQL on DuckDB and compare the results value by value."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if value is None or value is pd.NaT or value is pd.NA or (isinstance(value, float) and math.isnan(value)):
        return None
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, bool):
        return int(value)
    if isinstance(value, float) and value.is_integer() and abs(value) < 2**53:
        return int(value)
    if isinstance(value, float) and value == 0:
        return 0
    return value


def rows_of(frame: pd.DataFrame) -> list[tuple]:
    columns = sorted(frame.columns)
    cells = [[_cell(v) for v in frame[c].astype(object)] for c in columns]
    return sorted(zip(*cells), key=lambda row: tuple((v is not None, str(v)) for v in row)) if cells else []


def mismatch(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """None if equal; otherwise what differs."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} vs {sorted(sql_frame.columns)}"
    left, right = rows_of(spark_frame), rows_of(sql_frame)
    if len(left) != len(right):
        return f"{len(left)} rows vs {len(right)}"
    different = [(a, b) for a, b in zip(left, right) if a != b]
    return f"{len(different)} of {len(left)} rows differ, first {different[0]}" if different else None
