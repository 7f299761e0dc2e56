"""Surrogate keys without gaps."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakezones.session import stage
from lakezones.specs import quoted, unused_name

# monotonically_increasing_id() holds the partition above bit 33 and the row position below it.
POSITION_BITS = 33


def surrogate_key(
    df: DataFrame, order: Iterable[str], name: str = "customer_key", start_key: int | Column = 1
) -> DataFrame:
    """Number the rows ``start_key, start_key + 1, ...`` in ascending ``order``.

    Rows that are equal in ``order`` are numbered by a hash of all their columns.

    The sort is over range partitions, and through that hash it also splits a third of all rows
    with one order value. Each row then gets its position in its partition, and the rows are
    staged, because the partition bounds come from a sample and would differ in a second
    evaluation. What remains is one number per partition: the rows in the partitions before it.
    """
    place, part, offset = (unused_name([*df.columns, name], scratch) for scratch in ("_place", "_partition", "_offset"))
    hashed = [quoted(field.name) for field in df.schema if "map<" not in field.dataType.simpleString()]
    placed = stage(
        df.orderBy(*map(quoted, order), F.xxhash64(*hashed)).withColumn(place, F.monotonically_increasing_id()),
        "surrogate-key",
    )
    partition = F.shiftright(place, POSITION_BITS)
    position = F.col(place).bitwiseAND(F.lit((1 << POSITION_BITS) - 1))
    # One row per sort partition, at most spark.sql.shuffle.partitions of them.
    before = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(partition.alias(part))
        .agg(F.count("*").alias("rows"))
        .select(part, F.coalesce(F.sum("rows").over(before), F.lit(0)).alias(offset))
    )
    first = F.lit(start_key) if isinstance(start_key, int) else start_key
    return (
        placed.withColumn(part, partition)
        .join(F.broadcast(offsets), part)
        .withColumn(name, (first + F.col(offset) + position).cast("bigint"))
        .drop(part, offset, place)
    )


def next_key(table: DataFrame, name: str = "customer_key") -> int:
    """The first key that ``table`` has not used."""
    return (table.agg(F.max(quoted(name))).first()[0] or 0) + 1
