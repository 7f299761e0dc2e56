"""Column-level operators: project, drop, default, stamp, rename, retype."""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from datetime import date, datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakezones.fixed_values import DAY_FORMAT, PARTITION_COLUMN
from lakezones.functions.casts import guarded_timestamp
from lakezones.specs import quoted


def project(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """The named columns, matched without regard to case, under the names given."""
    return df.select(*[F.col(quoted(name)).alias(name) for name in columns])


def drop_payload(df: DataFrame, *columns: str) -> DataFrame:
    return df.drop(*columns)


def default_column(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add ``name`` only where the frame lacks it."""
    if name.lower() in (column.lower() for column in df.columns):
        return df
    return df.withColumn(name, value)


def ingest_stamp(df: DataFrame, run_time: datetime, name: str = "Updated_On") -> DataFrame:
    """Add the UTC time of the run, the same for all rows however often a task is retried."""
    if run_time.tzinfo is not None:
        run_time = run_time.astimezone(timezone.utc)
    return df.withColumn(name, F.lit(run_time.strftime("%Y-%m-%dT%H:%M:%SZ")).cast("timestamp"))


def partition_stamp(df: DataFrame, run_day: date, name: str = PARTITION_COLUMN) -> DataFrame:
    """Add the day of the run as ``yyyy-MM-dd`` text."""
    return df.withColumn(name, F.date_format(F.lit(run_day), DAY_FORMAT))


def load_rename_map(spark: SparkSession, path: str) -> dict[str, str]:
    """Read a ``{source: target}`` JSON file."""
    text = spark.read.text(path, wholetext=True).first()
    return json.loads(text[0]) if text else {}


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename by ``{source: target}``; names that the frame lacks are ignored."""
    return df.withColumnsRenamed(dict(mapping))


def stringify_all(df: DataFrame) -> DataFrame:
    """Every column as text; null stays null."""
    return df.select(*[F.col(quoted(name)).cast("string").alias(name) for name in df.columns])


def parse_timestamps(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Re-type the named text columns; a name that the frame lacks is an error."""
    columns = list(columns)
    missing = [name for name in columns if name not in df.columns]
    if missing:
        raise ValueError(f"no such timestamp columns: {missing}")
    return df.withColumns({name: guarded_timestamp(F.col(quoted(name))) for name in columns})
