"""Parquet export with a fixed column order."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame

from lakezones.fixed_values import EXPORT_COLUMNS, EXPORT_GZIP_LEVEL
from lakezones.operators.columns import project

# The names the zlib codec gives its levels.
GZIP_LEVELS = (
    "NO_COMPRESSION", "BEST_SPEED", "TWO", "THREE", "FOUR", "FIVE", "SIX", "SEVEN", "EIGHT", "BEST_COMPRESSION",
)


def parquet_export(
    df: DataFrame, path: str, columns: Iterable[str] = EXPORT_COLUMNS, level: int = EXPORT_GZIP_LEVEL
) -> None:
    """Write gzip Parquet below ``path``, as many files as there are tasks."""
    writer = project(df, columns).write.option("compression", "gzip")
    writer.option("zlib.compress.level", GZIP_LEVELS[level]).parquet(path)
