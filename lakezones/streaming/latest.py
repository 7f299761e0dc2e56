"""The latest record per key, held in the state store of a stream."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakezones.operators.filters import any_null, reject_null_keys
from lakezones.operators.measures import watermark_text
from lakezones.operators.merge import keys_fit_broadcast, not_older, time_of
from lakezones.session import stage
from lakezones.sinks.tables import Name, merge_or_create
from lakezones.sources.tables import read_table
from lakezones.specs import quoted, unused_name
from lakezones.streaming.watermark import WatermarkStore

log = logging.getLogger(__name__)

# One record per key is held, which belongs on disk and not on the heap.
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE_SETTINGS = {
    "spark.sql.streaming.stateStore.providerClass": STATE_STORE,
    # The report is the sum over the batches of a run.
    "spark.sql.streaming.numRecentProgressUpdates": "10000",
}
ARRIVALS = "arrivals"


@dataclass(frozen=True)
class StreamReport:
    """What one run of the stream has read."""

    rows: int = 0
    null_keys: int = 0
    without_time: int = 0
    late: int = 0
    watermark: str | None = None


def latest_by_state(
    spark: SparkSession,
    landing: str,
    schema: str,
    transform: Callable[[DataFrame], DataFrame],
    table: Name,
    keys: Iterable[str],
    order: str,
    checkpoint: str,
    state: WatermarkStore,
    load: str,
    ties: Iterable[str] = (),
    delay: str = "1 day",
    file_format: str = "text",
    max_files: int | None = None,
    provider: str = "parquet",
) -> StreamReport:
    """Bring ``table`` up to the latest record per key of all that has landed, then stop.

    The state of the stream holds, for each key, the latest record that ever landed, by the time
    ``order`` and then ``ties``; a text that names no time comes before all times. A record that
    lands again, or late, meets that state and changes nothing, so that such a run does not write
    the table. The state is a plain aggregate: every task first reduces its rows to one per key, and
    a key with a third of all rows sends one row per task.

    No record is ever dropped for being late. Records whose time lies more than ``delay`` before
    the greatest one of earlier runs are counted as ``late``; a key that only comes late is loaded
    all the same. The watermark advances after the run, so that a run that failed counts alike when
    it is repeated; its merges change nothing the second time.
    """
    keys, ties = list(keys), list(ties)
    for name, value in STATE_SETTINGS.items():
        spark.conf.set(name, value)
    query = _latest_query(
        spark, landing, schema, transform, table, keys, order, checkpoint, ties, state.read(load), delay, file_format,
        max_files, provider,
    )
    query.awaitTermination()
    report = _report(query)
    if report.late or report.null_keys:
        log.warning("%s: %d records came late, %d have no key", load, report.late, report.null_keys)
    state.advance(load, report.watermark)
    return report


def _latest_query(
    spark: SparkSession,
    landing: str,
    schema: str,
    transform: Callable[[DataFrame], DataFrame],
    table: Name,
    keys: list[str],
    order: str,
    checkpoint: str,
    ties: list[str],
    watermark: str | None,
    delay: str,
    file_format: str,
    max_files: int | None,
    provider: str,
) -> StreamingQuery:
    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    records = transform(reader.load(landing))
    columns = records.columns
    types = {field.name.lower(): field.dataType for field in records.schema}
    time = time_of(F.col(quoted(order)), types[order.lower()]).cast("timestamp")
    bound = F.lit(watermark).cast("timestamp") - F.expr(f"INTERVAL {delay}")
    arrived = records.observe(
        ARRIVALS,
        F.count(F.lit(1)).alias("rows"),
        F.count_if(any_null(keys)).alias("null_keys"),
        F.count_if(time.isNull()).alias("without_time"),
        F.count_if(time < bound).alias("late"),
        watermark_text(F.max(time)).alias("watermark"),
    )
    # Rows that are level in all of these are told apart by a hash, so that no run depends on their order.
    hashed = [quoted(field.name) for field in records.schema if "map<" not in field.dataType.simpleString()]
    place = F.struct(time, *[F.col(quoted(name)) for name in ties], F.xxhash64(*hashed))
    latest = unused_name(columns, "_latest")
    held = reject_null_keys(arrived, keys).groupBy(*[F.col(quoted(key)) for key in keys]).agg(
        F.max_by(F.struct(*[F.col(quoted(name)) for name in columns]), place).alias(latest)
    )

    def merge_batch(batch: DataFrame, _batch_id: int) -> None:
        rows = stage(batch.select(*[F.col(latest)[name].alias(name) for name in columns]), "stream-latest")
        target = read_table(spark, table)
        if target is not None:
            small = keys_fit_broadcast(rows, keys)
            rows = stage(not_older(rows, target, keys, [order, *ties], small, [order], level=False), "stream-latest")
        if not rows.isEmpty():
            merge_or_create(rows, table, keys, provider, staged=True, unique=True)

    return (
        held.writeStream.outputMode("update")
        .foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _report(query: StreamingQuery) -> StreamReport:
    seen = [progress.observedMetrics[ARRIVALS] for progress in query.recentProgress if ARRIVALS in progress.observedMetrics]
    if not seen:
        return StreamReport()
    counts = {name: sum(row[name] or 0 for row in seen) for name in ("rows", "null_keys", "without_time", "late")}
    return StreamReport(**counts, watermark=max((row["watermark"] for row in seen if row["watermark"]), default=None))
