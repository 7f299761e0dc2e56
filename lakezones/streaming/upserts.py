"""Upsert landed files as they arrive."""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakezones.operators.dedup import deduplicate_latest
from lakezones.operators.filters import reject_null_keys
from lakezones.operators.merge import keys_fit_broadcast, not_older
from lakezones.session import stage
from lakezones.sinks.tables import Name, merge_or_create
from lakezones.sources.tables import read_table


def upsert_new_files(
    spark: SparkSession,
    landing: str,
    schema: str,
    transform: Callable[[DataFrame], DataFrame],
    table: Name,
    keys: Iterable[str],
    order: str,
    checkpoint: str,
    ties: Iterable[str] = (),
    file_format: str = "text",
    max_files: int | None = None,
    provider: str = "parquet",
    times: Iterable[str] = (),
) -> StreamingQuery:
    """Merge everything that landed since the last run into ``table``, then stop.

    The checkpoint remembers which files were merged. A record replaces the one of the table only
    if it is at least as late, by ``order`` and then ``ties``. So the table does not depend on the
    order in which files land, on ``max_files``, which bounds the files of one batch when a backlog
    is large, or on a batch that is repeated after a failure. Text columns named in ``times`` are
    compared as times, unreadable ones as none. ``provider`` is the format of a table
    that is created; one with row-level operations is not rewritten by every batch.
    """
    keys, ties, times = list(keys), list(ties), list(times)

    def merge_batch(batch: DataFrame, _batch_id: int) -> None:
        records = reject_null_keys(transform(batch), keys)
        latest = stage(deduplicate_latest(records, keys, order, ties=ties, times=times), "stream-batch")
        target = read_table(spark, table)
        if target is not None:
            small = keys_fit_broadcast(latest, keys)
            latest = stage(not_older(latest, target, keys, [order, *ties], small, times), "stream-batch")
        if not latest.isEmpty():
            merge_or_create(latest, table, keys, provider, staged=True, unique=True)

    reader = spark.readStream.format(file_format).schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return (
        reader.load(landing)
        .writeStream.foreachBatch(merge_batch)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
