"""Filters and gates. Each predicate is written so that it reaches the Parquet scan."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakezones.fixed_values import EPOCH_FLOOR
from lakezones.specs import quoted


def since(df: DataFrame, column: str, watermark: str | None) -> DataFrame:
    """Rows changed at or after the watermark; all rows when there is none yet."""
    if watermark is None:
        return df
    return df.filter(_time(df, column) >= _like_column(df, column, watermark))


def epoch_floor(df: DataFrame, column: str = "created") -> DataFrame:
    """Drop rows from before 1970 and rows without a time."""
    return df.filter(_time(df, column) >= _like_column(df, column, EPOCH_FLOOR))


def _like_column(df: DataFrame, column: str, text: str) -> Column:
    """A time literal of the column's own type; a cast on the column would not be pushed down."""
    type_name = df.select(F.col(quoted(column))).schema[0].dataType.typeName()
    if type_name == "timestamp_ntz":
        return F.lit(text.removesuffix("Z")).cast("timestamp_ntz")
    return F.lit(text).cast("timestamp")


def _is_text(df: DataFrame, column: str) -> bool:
    return isinstance(df.select(F.col(quoted(column))).schema[0].dataType, T.StringType)


def _time(df: DataFrame, column: str) -> Column:
    """The column itself, or the time that its text names; texts of different forms do not sort by time."""
    value = F.col(quoted(column))
    return F.try_to_timestamp(value) if _is_text(df, column) else value


def any_null(keys: Iterable[str]) -> Column:
    nulls = [F.col(quoted(key)).isNull() for key in keys]
    result = nulls[0]
    for null in nulls[1:]:
        result = result | null
    return result


def reject_null_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    return df.filter(~any_null(list(keys)))


def latest_day(df: DataFrame, column: str = "ingest_timestamp") -> DataFrame:
    """The rows of the last day found in ``column``; none when it holds no time at all.

    No row lies after the last day, so its midnight alone bounds the snapshot. The bound is a
    scalar subquery that reads one column and is pushed down to the scan of the others. A text
    column is parsed; rows whose text is no time are not of the last day.
    """
    midnight = df.agg(F.max(_time(df, column)).alias("last")).select(_midnight(df, column))
    return df.filter(_time(df, column) >= midnight.scalar())


def _midnight(df: DataFrame, column: str) -> Column:
    data_type = df.select(_time(df, column)).schema[0].dataType
    return F.date_trunc("day", "last").cast(data_type)


def day_range(df: DataFrame, column: str, first: date, last: date) -> DataFrame:
    """Rows from ``first`` to ``last``, both days included."""
    day = F.col(quoted(column))
    return df.filter((day >= F.lit(first)) & (day < F.lit(last + timedelta(days=1))))


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()
