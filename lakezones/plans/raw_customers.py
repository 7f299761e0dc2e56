"""Landed pages to the raw customer table."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakezones.fixed_values import REFINED_INPUT_COLUMNS
from lakezones.functions.casts import iso_timestamp, numeric_key
from lakezones.operators.columns import ingest_stamp, project
from lakezones.operators.dedup import deduplicate_latest
from lakezones.operators.filters import any_null, epoch_floor, reject_null_keys
from lakezones.operators.keys import surrogate_key
from lakezones.operators.measures import watermark_text
from lakezones.operators.merge import keys_fit_broadcast
from lakezones.session import stage
from lakezones.sinks.tables import Name, merge_or_create
from lakezones.sources.pages import flatten_pages
from lakezones.sources.tables import read_table
from lakezones.streaming.watermark import WatermarkStore

log = logging.getLogger(__name__)

KEY = "customer_id"


@dataclass(frozen=True)
class RawLoad:
    rows: int
    null_keys: int
    watermark: str | None
    without_time: int = 0


def raw_records(pages: DataFrame, run_time: datetime, watermark: str | None = None) -> DataFrame:
    """The typed records of the pages that changed since the watermark.

    Records without a readable time of change are always among them.
    """
    records = flatten_pages(pages)
    if watermark is not None:
        updated = iso_timestamp(F.col("updated"))
        records = records.filter((updated >= F.lit(watermark).cast("timestamp")) | updated.isNull())
    typed = records.withColumns(
        {KEY: numeric_key(F.col(KEY)), "created": iso_timestamp(F.col("created"))}
    )
    return ingest_stamp(epoch_floor(typed), run_time)


def latest_records(records: DataFrame) -> DataFrame:
    """The latest record per customer by the time of change; equal times are settled by the record text."""
    kept = reject_null_keys(records, [KEY])
    return deduplicate_latest(kept, KEY, "updated", ties=["Content"], times=["updated"])


def place_in_time(content: str = "content") -> Column:
    """What orders two records of a customer: the time of change, none first, then the record text."""
    time = iso_timestamp(F.col("updated"))
    return F.struct(time.isNotNull(), time, F.col(content).isNotNull(), F.col(content))


def with_customer_keys(latest: DataFrame, target: DataFrame | None) -> DataFrame:
    """The records that no record of the target comes after, with their customer keys.

    Customers that the target knows keep their key; the others are numbered after its last key.
    The target is read once: of the customers at hand their key and latest record, and of all rows
    the greatest key.
    """
    if target is None:
        return surrogate_key(latest, ["created", KEY])
    last_key = Observation()
    place = place_in_time().alias("_place")
    held = target.select(F.col(KEY).alias("_held"), "customer_key", place)
    held = held.observe(last_key, F.max("customer_key").alias("last"))
    wanted = latest.select(F.col(KEY).alias("_held"))
    if keys_fit_broadcast(latest, [KEY]):
        wanted = F.broadcast(wanted)
    known = held.join(wanted, "_held", "left_semi").groupBy("_held").agg(
        F.min("customer_key").alias("customer_key"), F.max("_place").alias("_place")
    )
    found = stage(latest.join(known, F.col(KEY) == F.col("_held"), "left").drop("_held"), "raw-known")
    new = surrogate_key(
        found.filter("customer_key IS NULL").drop("customer_key", "_place"),
        ["created", KEY],
        start_key=(last_key.get["last"] or 0) + 1,
    )
    newer = F.col("_place").isNull() | (place_in_time("Content") >= F.col("_place"))
    return found.filter(F.col("customer_key").isNotNull() & newer).drop("_place").unionByName(new)


def load_raw_customers(
    pages: DataFrame,
    table: Name,
    state: WatermarkStore,
    run_time: datetime,
    load: str = "customers",
    provider: str = "parquet",
    full: bool = False,
) -> RawLoad:
    """Merge the records changed since the watermark, or all if ``full``, into ``table``; then advance it.

    A record replaces the one of the table unless that comes later, by the time of change and then
    by the record text. Records without a readable time are part of every load and come before all
    others. So the table depends neither on the order in which records arrive nor on how they are
    split into loads.

    The pages are read once: the latest record per customer is staged, and the job that does so
    also counts all records and finds the watermark. If the load fails before its last step, the old
    watermark makes the next run read the same records again.
    """
    spark, seen = pages.sparkSession, Observation()
    updated = iso_timestamp(F.col("updated"))
    records = raw_records(pages, run_time, None if full else state.read(load)).observe(
        seen,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(any_null([KEY])).alias("null_keys"),
        watermark_text(F.max(updated)).alias("watermark"),
        F.count_if(updated.isNull()).alias("without_time"),
    )
    latest = stage(latest_records(records), "raw-latest")
    report = RawLoad(**seen.get)
    if report.null_keys:
        log.warning("%d rows without %s are left out", report.null_keys, KEY)
    if report.without_time:
        log.warning("%d rows have no readable time of change", report.without_time)
    if report.rows > report.null_keys:
        keyed = project(with_customer_keys(latest, read_table(spark, table)), REFINED_INPUT_COLUMNS)
        if not keyed.isEmpty():
            # Cheap to read again: staged records and one offset per partition.
            merge_or_create(keyed, table, [KEY], provider, staged=True, unique=True)
    state.advance(load, report.watermark)
    return report
