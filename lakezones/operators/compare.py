"""Which rows differ between two states of a table, by key."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakezones.session import stage
from lakezones.specs import quoted, unused_name

INSERTED, UPDATED, DELETED, UNCHANGED = "inserted", "updated", "deleted", "unchanged"

# Rows of a range on average, and bounds for the number of ranges.
ROWS_IN_RANGE = 50_000
FEWEST_RANGES, MOST_RANGES = 64, 1_000_000


def row_digest(columns: Iterable[str], types: dict[str, str]) -> Column:
    """128 bits of a row as two numbers; maps are compared as sorted entries."""
    values = []
    for name in columns:
        value = F.col(quoted(name))
        values.append(F.array_sort(F.map_entries(value)) if types[name].startswith("map<") else value)
    # A null is not the same as its absence before the next value.
    parts = [part for value in values for part in (value.isNull(), value)]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit(1), *parts, F.lit(2)).alias("b"))


@dataclass(frozen=True)
class TableDiff:
    """The keys that differ, with their status and rows before and after, and how much was looked at."""

    changes: DataFrame
    ranges: int
    differing: int


def table_diff(before: DataFrame, after: DataFrame, keys: Iterable[str], ranges: int | None = None) -> TableDiff:
    """The keys whose rows were inserted, updated or deleted from ``before`` to ``after``.

    Two levels of digests: rows fall into ranges by the hash of their key, and each range has the
    number and the sums of the digests of its rows, which map-side aggregation makes small. Only
    ranges whose digests differ are looked into, row by row. If few keys changed, hardly any row is
    shuffled; a key with very many rows is one row per task.

    Columns are matched by name, and both sides must have the same. Null keys are keys like others. A
    key that occurs several times counts as updated if its rows are not the same ones as often.
    """
    keys = list(keys)
    names = {name.lower(): name for name in after.columns}
    if {name.lower() for name in before.columns} != set(names):
        raise ValueError("the tables have different columns")
    columns = [name for lower, name in names.items() if lower not in {key.lower() for key in keys}]
    key, part, digest, count = (unused_name(after.columns, name) for name in ("_key", "_range", "_digest", "_rows"))
    types = {field.name: field.dataType.simpleString() for field in after.schema}
    before = before.select(*[F.col(quoted(name)).cast(after.schema[name].dataType).alias(name) for name in after.columns])
    if ranges is None:
        rows = max(before.count(), after.count())
        ranges = min(max(rows // ROWS_IN_RANGE, FEWEST_RANGES), MOST_RANGES)

    def digested(df: DataFrame) -> DataFrame:
        small = df.select(
            *[F.col(quoted(name)) for name in keys],
            F.xxhash64(*[part for name in keys for part in (F.col(quoted(name)).isNull(), F.col(quoted(name)))]).alias(key),
            row_digest(columns, types).alias(digest),
        )
        return small.withColumn(part, F.pmod(F.col(key), F.lit(ranges)))

    def summed() -> list[Column]:
        # Sums of 64-bit numbers do not depend on the order; the decimals cannot overflow.
        halves = [F.sum(F.col(digest)[half].cast("decimal(38,0)")).alias(f"{digest}_{half}") for half in ("a", "b")]
        return [F.count("*").alias(count), *halves]

    def range_digest(df: DataFrame) -> DataFrame:
        keyed = F.struct(F.xxhash64(key, f"{digest}.a").alias("a"), F.xxhash64(f"{digest}.b", key).alias("b"))
        return df.withColumn(digest, keyed).groupBy(part).agg(*summed())

    left, right = digested(before), digested(after)
    sums = [count, f"{digest}_a", f"{digest}_b"]
    old, new = range_digest(left), range_digest(right)
    same = F.lit(True)
    for name in sums:
        same = same & F.col(f"old.{quoted(name)}").eqNullSafe(F.col(f"new.{quoted(name)}"))
    both = old.alias("old").join(new.alias("new"), F.col(f"old.{quoted(part)}") == F.col(f"new.{quoted(part)}"), "full_outer")
    # One number per differing range.
    open_ranges = stage(both.filter(~same).select(F.coalesce(f"old.{quoted(part)}", f"new.{quoted(part)}").alias(part)), "diff-ranges")
    differing = open_ranges.count()

    def by_key(df: DataFrame) -> DataFrame:
        looked_into = df.join(F.broadcast(open_ranges), part, "left_semi")
        return looked_into.groupBy(*[F.col(quoted(name)) for name in keys]).agg(*summed())

    pairs = by_key(left).alias("old").join(
        by_key(right).alias("new"),
        [F.col(f"old.{quoted(name)}").eqNullSafe(F.col(f"new.{quoted(name)}")) for name in keys],
        "full_outer",
    )
    rows_before, rows_after = F.col(f"old.{quoted(count)}"), F.col(f"new.{quoted(count)}")
    status = F.when(rows_before.isNull(), INSERTED).when(rows_after.isNull(), DELETED).when(same, UNCHANGED).otherwise(UPDATED)
    changes = pairs.select(
        *[
            F.when(rows_after.isNull(), F.col(f"old.{quoted(name)}")).otherwise(F.col(f"new.{quoted(name)}")).alias(name)
            for name in keys
        ],
        status.alias("status"),
        F.coalesce(rows_before, F.lit(0)).alias("rows_before"),
        F.coalesce(rows_after, F.lit(0)).alias("rows_after"),
    ).filter(F.col("status") != UNCHANGED)
    return TableDiff(changes, ranges, differing)
