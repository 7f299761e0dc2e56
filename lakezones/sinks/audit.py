"""Overwrite a table only if its new content passes checks, which are counted while it is written."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakezones.operators.filters import any_null
from lakezones.operators.merge import align
from lakezones.sinks.tables import ROW_LEVEL_FORMATS, Name, new_folder, partition_columns, set_location, table_description
from lakezones.sources.tables import parquet_row_count, read_table, register_dataset, table_row_count
from lakezones.specs import quoted_table

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Audit:
    """The numbers of rows before and after, and what was counted over the new ones."""

    table: str
    rows_before: int
    rows_after: int
    counts: Mapping[str, object] = field(default_factory=dict)

    @property
    def changed(self) -> int:
        return self.rows_after - self.rows_before


class AuditFailed(ValueError):
    """The new content did not pass its checks; the table is as it was."""

    def __init__(self, audit: Audit, problems: list[str], folder: str):
        super().__init__(f"{audit.table}: {'; '.join(problems)}; the rejected content is in {folder}")
        self.audit, self.problems, self.folder = audit, problems, folder


@dataclass(frozen=True)
class Check:
    """An aggregate over the new rows, if it needs one, and the problem that it may show."""

    name: str
    problem: Callable[[Audit], str | None]
    count: Column | None = None


def at_least(rows: int) -> Check:
    """The new content has ``rows`` rows."""
    return Check("rows", lambda audit: f"{audit.rows_after} rows, {rows} are needed" if audit.rows_after < rows else None)


def no_null_keys(keys: Iterable[str], most: int = 0) -> Check:
    """At most ``most`` rows have a null in ``keys``."""
    keys = list(keys)
    name = f"null_{'_'.join(keys)}"

    def problem(audit: Audit) -> str | None:
        found = audit.counts[name]
        return f"{found} rows without {', '.join(keys)}" if found > most else None

    return Check(name, problem, F.count_if(any_null(keys)))


def keeps(share: float) -> Check:
    """The number of rows does not fall below ``share`` of what it was."""

    def problem(audit: Audit) -> str | None:
        fallen = audit.rows_after < share * audit.rows_before
        return f"{audit.rows_after} rows are left of {audit.rows_before}" if fallen else None

    return Check("keeps", problem)


def audited_overwrite(df: DataFrame, table: Name, checks: Iterable[Check]) -> Audit:
    """Replace all rows of ``table``, or create it, if the new content passes all ``checks``.

    The content is written once, to a new folder, and the aggregates of the checks are
    observed as it is written; only then is the catalog entry moved to it. The number of rows is that of
    the written files, taken from their footers. Where an executor is lost and rows are written
    again, an observed count may be too high, never too low: a check on bad rows may then fail for
    content that a second run accepts, but lets no bad content pass.
    """
    spark, checks = df.sparkSession, list(checks)
    target = read_table(spark, table)
    if target is not None:
        described = dict(table_description(spark, table))
        if described.get("Provider", "").lower() in ROW_LEVEL_FORMATS or partition_columns(spark, table):
            raise ValueError(f"{quoted_table(table)} is no unpartitioned Parquet table")
        df = align(df, target.schema)
    folder, seen = new_folder(spark, table), Observation()
    counts = [check.count.alias(check.name) for check in checks if check.count is not None]
    observed = df.observe(seen, *counts) if counts else df
    observed.write.option("compression", "snappy").parquet(folder)
    audit = Audit(
        quoted_table(table), table_row_count(spark, table), parquet_row_count(spark, folder), seen.get if counts else {}
    )
    problems = [problem for check in checks if (problem := check.problem(audit))]
    if problems:
        raise AuditFailed(audit, problems, folder)
    if target is None:
        register_dataset(spark, table, folder, schema=df.schema)
    else:
        set_location(spark, table, folder)
    log.info("%s: %d rows, %d before", audit.table, audit.rows_after, audit.rows_before)
    return audit
