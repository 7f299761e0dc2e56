"""Date windows of a backfill: generate them, plan the extracts, assign rows to them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakezones.fixed_values import WINDOW_STEP_DAYS
from lakezones.specs import quoted


def add_windows(
    df: DataFrame, start: Column, end: Column, step_days: int = WINDOW_STEP_DAYS, clamp: bool = False
) -> DataFrame:
    """Each row once per window from ``start`` to ``end``, with the window's first and last day.

    A window covers ``step_days`` days, both ends included, so the last one may pass ``end``;
    ``clamp`` cuts it there. A start after the end gives no window.
    """
    first, past = start.cast("date"), end.cast("date")
    starts = F.when(first <= past, F.sequence(first, past, F.make_dt_interval(F.lit(step_days))))
    last = F.date_add("start_date", step_days - 1)
    return df.select("*", F.explode(starts).alias("start_date")).withColumn(
        "end_date", F.least(last, past) if clamp else last
    )


def date_windows(
    spark: SparkSession, start: date, end: date, step_days: int = WINDOW_STEP_DAYS, clamp: bool = False
) -> DataFrame:
    """One row per window between two given days."""
    return add_windows(spark.range(1), F.lit(start), F.lit(end), step_days, clamp).drop("id")


def windows_of(
    df: DataFrame, column: str, step_days: int = WINDOW_STEP_DAYS, clamp: bool = False
) -> DataFrame:
    """One row per window between the first and the last day found in ``column``."""
    at = quoted(column)
    bounds = df.agg(F.min(at).alias("_first"), F.max(at).alias("_last"))
    return add_windows(bounds, F.col("_first"), F.col("_last"), step_days, clamp).drop("_first", "_last")


def worklist(
    centers: DataFrame, start: Column, end: Column, step_days: int = WINDOW_STEP_DAYS, clamp: bool = False
) -> DataFrame:
    """One extract per center and window. Each center row unfolds its own windows: nothing is shuffled."""
    return add_windows(centers, start, end, step_days, clamp)


def assign_window(
    df: DataFrame, column: str, start: date, end: date, step_days: int = WINDOW_STEP_DAYS, clamp: bool = False
) -> DataFrame:
    """Keep the rows inside the windows and add the window each belongs to.

    Windows follow each other without gaps, so the window is computed from the day: there is no
    join, and the outer bounds reach the scan.
    """
    at = F.col(quoted(column))
    first = F.lit(start)
    windows = (end - start).days // step_days + 1 if start <= end else 0
    past = F.lit(end) if clamp else F.date_add(first, windows * step_days - 1)
    day = at.cast("date")
    start_date = F.date_add(first, F.floor(F.datediff(day, first) / step_days).cast("int") * step_days)
    end_date = F.date_add(start_date, step_days - 1)
    return df.filter((at >= first) & (at < F.date_add(past, 1))).select(
        "*", start_date.alias("start_date"), (F.least(end_date, past) if clamp else end_date).alias("end_date")
    )
