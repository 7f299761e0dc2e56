"""Counts, watermarks and the row-count checks of a load."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakezones.fixed_values import MINIMUM_ROWS, PREVIEW_ROWS, WATERMARK_FORMAT
from lakezones.functions.casts import iso_timestamp
from lakezones.operators.filters import any_null
from lakezones.specs import quoted


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("rows"))


def preview(df: DataFrame, order: str, rows: int = PREVIEW_ROWS) -> DataFrame:
    """The first rows in ``order``, for the log. Each task keeps that many rows, none sorts them all."""
    return df.orderBy(quoted(order)).limit(rows)


def watermark_text(latest: Column) -> Column:
    """A time as watermark: ISO-8601, UTC, whole seconds."""
    return F.date_format(latest, WATERMARK_FORMAT)


def max_watermark(df: DataFrame, column: str = "updated") -> DataFrame:
    """The watermark after loading ``df``; null when no row holds a time. Texts that name no time are left out."""
    value = F.col(quoted(column))
    text = isinstance(df.select(value).schema[0].dataType, T.StringType)
    time = iso_timestamp(value) if text else value.cast("timestamp")
    return df.agg(watermark_text(F.max(time)).alias("watermark"))


def null_key_count(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.agg(
        F.count("*").alias("rows"),
        F.count_if(any_null(keys)).alias("null_keys"),
    )


def count_delta(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows before and after a load, and whether it inserted, deleted or left them unchanged."""
    change = F.col("rows_after") - F.col("rows_before")
    return (
        after.agg(F.count("*").alias("rows_after"))
        .withColumn("rows_before", row_count(before).scalar())
        .select("rows_before", "rows_after", F.abs(change).alias("changed"), delta_status(change).alias("status"))
    )


def delta_status(change: Column) -> Column:
    return F.when(change > 0, "inserted").when(change == 0, "unchanged").otherwise("deleted")


def min_rows_check(df: DataFrame, minimum: int = MINIMUM_ROWS) -> DataFrame:
    return row_count(df).withColumn("success", F.col("rows") >= minimum)


@dataclass(frozen=True)
class LoadReport:
    """What one load did to its target."""

    table: str
    rows_before: int
    rows_after: int
    minimum: int = MINIMUM_ROWS

    @property
    def changed(self) -> int:
        return self.rows_after - self.rows_before

    @property
    def status(self) -> str:
        return "inserted" if self.changed > 0 else "unchanged" if self.changed == 0 else "deleted"

    @property
    def success(self) -> bool:
        return self.rows_after >= self.minimum

    def message(self) -> str:
        if self.status == "unchanged":
            text = f"{self.table}: no new rows"
        else:
            text = f"{self.table}: {abs(self.changed)} rows were {self.status}"
        check = "at least" if self.success else "fewer than"
        return f"{text}; {check} {self.minimum} rows ({self.rows_after})"
