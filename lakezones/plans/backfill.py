"""Historical order extracts to the raw order table."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from lakezones.fixed_values import ORDER_TIMESTAMP_COLUMNS, PARTITION_COLUMN
from lakezones.functions.casts import iso_timestamp
from lakezones.operators.columns import parse_timestamps, partition_stamp
from lakezones.operators.filters import day_range
from lakezones.plans.runner import run_tables
from lakezones.sinks.tables import Name, append_partitions
from lakezones.sources.delimited import REJECTED, accepted_rows, read_sources
from lakezones.specs import TableSpec, quoted, unused_name

log = logging.getLogger(__name__)


def backfill_orders(
    spark: SparkSession,
    paths: Iterable[str],
    run_day: date,
    timestamp_columns: Iterable[str] = ORDER_TIMESTAMP_COLUMNS,
    ship_date: str | None = None,
    first: date | None = None,
    last: date | None = None,
    multi_line: bool = True,
    short_rows: bool = True,
    rejects: bool = False,
) -> DataFrame:
    """The landed extracts of all centers, typed and stamped with the day of the run.

    All windows are read in one job: Spark runs as many of the landed files at once as there
    are cores. With ``ship_date`` only rows from ``first`` to ``last`` are kept, for extracts
    that hold more than was asked for. Without ``multi_line``, for extracts that have no line
    breaks inside quotes, one large file is read by several tasks. Rows that do not fit the header
    of their extract are left out; with ``rejects`` they stay, marked in the column ``REJECTED``.
    """
    orders = read_sources(spark, paths, multi_line, short_rows=short_rows)
    if not orders.columns:
        return orders
    if ship_date is not None and first is not None and last is not None:
        name = unused_name(orders.columns, "_ship_day")
        day = orders.withColumn(name, iso_timestamp(F.col(quoted(ship_date))))
        # What a ragged row holds in this column means nothing.
        inside = day_range(day.filter(F.col(REJECTED).isNull()), name, first, last)
        orders = inside.unionByName(day.filter(F.col(REJECTED).isNotNull())).drop(name)
    stamped = partition_stamp(parse_timestamps(orders, timestamp_columns), run_day)
    return stamped if rejects else accepted_rows(stamped)


class TooManyRejects(ValueError):
    """More rows than allowed do not fit the header of their extract."""


@dataclass(frozen=True)
class BackfillReport:
    """Rows that were appended, and rows that were put into the table of rejects."""

    rows: int = 0
    rejected: int = 0

    def __bool__(self) -> bool:
        return self.rows > 0


def load_backfill(
    orders: DataFrame,
    table: Name,
    replace: bool = False,
    provider: str = "parquet",
    rejects_table: Name | None = None,
    most_rejects: int | None = None,
) -> BackfillReport:
    """Append the backfill under its run day; the report is false if there was nothing to append.

    The extracts are parsed and written once, and the rows are counted meanwhile. Where
    ``backfill_orders`` has kept its rejects, they are left out of ``table``; if there are any, they
    are read once more and appended to ``rejects_table``. With ``most_rejects`` they are counted
    first, and more of them are an error before anything is written.
    """
    if not orders.columns:
        log.info("no orders for %s, nothing is written", table)
        return BackfillReport()
    checked = REJECTED in orders.columns
    bad = F.col(REJECTED).isNotNull() if checked else F.lit(False)
    if most_rejects is not None and checked:
        found = orders.filter(bad).count()
        if found > most_rejects:
            raise TooManyRejects(f"{found} rows do not fit their header, {most_rejects} are allowed: {table}")
    good = accepted_rows(orders) if checked else orders
    written = not good.isEmpty()
    seen, rows = Observation(), 0
    counted = orders.observe(seen, F.count_if(~bad).alias("rows"), F.count_if(bad).alias("rejected"))
    if written:
        append_partitions(accepted_rows(counted) if checked else counted, table, replace=replace, provider=provider, empty=False)
        rows, rejected = seen.get["rows"], seen.get["rejected"]
    else:
        log.info("no orders for %s, nothing is written", table)
        rejected = orders.filter(bad).count() if checked else 0
    if rejected:
        log.warning("%s: %d rows do not fit the header of their extract", table, rejected)
        if rejects_table is not None:
            kept = orders.filter(bad).select(f"{REJECTED}.*", PARTITION_COLUMN)
            append_partitions(kept, rejects_table, replace=replace, provider=provider, empty=False)
    return BackfillReport(rows, rejected)


def load_backfills(
    spark: SparkSession,
    specs: Sequence[TableSpec],
    database: str,
    run_day: date,
    replace: bool = False,
    provider: str = "parquet",
    multi_line: bool = True,
    most_rejects: int | None = None,
) -> dict[str, BackfillReport]:
    """The backfill of several tables, each from its own sources; a failing one does not stop the others.

    Rows that do not fit their header go to a table of their own next to each, ``..._rejects``.
    """

    def load(spec: TableSpec) -> BackfillReport:
        orders = backfill_orders(
            spark, spec.sources, run_day, spec.timestamp_columns, multi_line=multi_line, rejects=True
        )
        rejects_table = (database, f"{spec.name}_rejects")
        return load_backfill(orders, (database, spec.name), replace, provider, rejects_table, most_rejects)

    return run_tables(specs, load)
