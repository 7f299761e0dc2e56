"""Refined to curated: merge the latest ingest day."""

from __future__ import annotations

import logging

from pyspark.sql import SparkSession

from lakezones.operators.filters import latest_day
from lakezones.session import stage
from lakezones.sinks.tables import merge_or_create
from lakezones.sources.tables import read_table
from lakezones.specs import TableSpec

log = logging.getLogger(__name__)


def load_curated(
    spark: SparkSession,
    spec: TableSpec,
    refined_database: str,
    curated_database: str,
    ingest_column: str = "ingest_timestamp",
    provider: str = "parquet",
) -> bool:
    """Upsert the rows of the latest ingest day; False if there are none.

    Two rows of that day with the same key are an error when the key is in the curated table:
    which of them should win is for the refined zone to say.
    """
    refined = read_table(spark, (refined_database, spec.name))
    if refined is None:
        log.info("no refined table %s", spec.name)
        return False
    snapshot = stage(latest_day(refined, ingest_column), "latest-day")
    if snapshot.isEmpty():
        log.info("no data in refined table %s", spec.name)
        return False
    merge_or_create(snapshot, (curated_database, spec.name), spec.primary_keys, provider, staged=True)
    return True
