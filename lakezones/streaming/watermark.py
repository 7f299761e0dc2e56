"""The watermark of an incremental load, one row per advance."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakezones.sources.tables import unless_missing


class WatermarkStore:
    """Watermarks of several loads in one Parquet folder.

    Advancing appends a row and reading takes the greatest: an advance either is there or is
    not, and repeating one changes nothing.
    """

    SCHEMA = "load string, watermark string"

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def history(self) -> DataFrame | None:
        return unless_missing(lambda: self.spark.read.schema(self.SCHEMA).parquet(self.path), None)

    def read(self, load: str) -> str | None:
        """The last watermark; None before the first load."""
        history = self.history()
        if history is None:
            return None
        return history.filter(F.col("load") == load).agg(F.max("watermark")).first()[0]

    def advance(self, load: str, watermark: str | None) -> None:
        """Store the new watermark; nothing happens when the load saw no time."""
        if watermark is not None:
            row = self.spark.range(0, 1, 1, 1).select(F.lit(load).alias("load"), F.lit(watermark).alias("watermark"))
            row.write.mode("append").parquet(self.path)
