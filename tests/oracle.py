"""Compare a registered query with its SQL on DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def kind(series: pd.Series) -> str:
    values = series.dropna()
    if values.empty:
        return "null"
    if pd.api.types.is_bool_dtype(values):
        return "bool"
    if pd.api.types.is_integer_dtype(values):
        return "integer"
    if pd.api.types.is_float_dtype(values):
        return "integer" if (values == values.round()).all() and series.isna().any() else "float"
    if pd.api.types.is_datetime64_any_dtype(values):
        return "time"
    return type(values.iloc[0]).__name__


def text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value) or value is pd.NA:
        return "null"
    if isinstance(value, pd.Timestamp):
        return value.isoformat()
    if hasattr(value, "item"):
        value = value.item()
    if isinstance(value, float):
        return repr(int(value)) if value.is_integer() else repr(value)
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).isoformat()
    return str(value)


def normalized(frame: pd.DataFrame) -> list[tuple[str, ...]]:
    columns = [[text(value) for value in frame[name]] for name in sorted(frame.columns)]
    return sorted(zip(*columns))


def compare(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} / {sorted(sql_frame.columns)}"
    if len(spark_frame) != len(sql_frame):
        return f"rows {len(spark_frame)} / {len(sql_frame)}"
    for name in spark_frame.columns:
        kinds = {kind(spark_frame[name]), kind(sql_frame[name])} - {"null"}
        kinds = {"time" if k in ("date", "Timestamp") else k for k in kinds}
        if len(kinds) > 1:
            return f"types of {name}: {kinds}"
    ours, theirs = normalized(spark_frame), normalized(sql_frame)
    for mine, other in zip(ours, theirs):
        if mine != other:
            return f"{mine} / {other}"
    return None
