"""Upsert as a plain DataFrame: matched rows replaced, other rows of both sides kept."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakezones.functions.casts import iso_timestamp
from lakezones.operators.filters import any_null, reject_null_keys
from lakezones.specs import quoted, unused_name


# Batch keys up to this size are broadcast, which spares the shuffle of the whole target.
BROADCAST_BYTES = 256 << 20
BYTES_PER_ENTRY = 32

# Copies of one batch row that one task writes, where the row matches that many target rows.
COPIES_PER_PIECE = 100_000


class MergeCardinalityError(ValueError):
    """A target row is matched by more than one row of the batch."""


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bring the columns into the order, names and types of ``schema``, matched by name.

    Case does not matter, further columns are ignored, a missing column is an error.
    """
    by_name = {name.lower(): name for name in df.columns}
    missing = [f.name for f in schema if f.name.lower() not in by_name]
    if missing:
        raise ValueError(f"the batch lacks columns of the target: {missing}")
    return df.select(
        *[F.col(quoted(by_name[f.name.lower()])).cast(f.dataType).alias(f.name) for f in schema]
    )


def keys_fit_broadcast(source: DataFrame, keys: Iterable[str]) -> bool:
    """Measure the keys of the batch, each with the overhead of its entry in a hash table."""
    widths = [F.coalesce(F.octet_length(F.col(quoted(key)).cast("string")), F.lit(0)) for key in keys]
    size = F.sum(sum(widths, F.lit(BYTES_PER_ENTRY)))
    return (source.agg(size).first()[0] or 0) <= BROADCAST_BYTES


def merge_frames(
    target: DataFrame, source: DataFrame, keys: Iterable[str], broadcast_keys: bool = False, tasks: int | None = None
) -> DataFrame:
    """Target rows without a match, one batch row for each matched target row, and the new batch rows.

    A null key matches nothing, so such rows of either side stay as they are. A batch row that
    matches several target rows replaces each of them, so no target row is lost.

    The target is read once in full and once for its keys, the batch several times: pass a table
    or a staged frame. With ``broadcast_keys``, for which ``keys_fit_broadcast`` must hold, the
    target is not shuffled, only the counts of the keys that the batch matches are. Otherwise
    Spark decides by size; if it shuffles, it does so on the keys, and the adaptive skew join
    splits a hot key of the target. ``tasks`` is the number of tasks that copies of rows are dealt out to, for hot keys:
    by default Spark puts pieces together by their bytes, not by the copies that come of them.
    """
    keys = list(keys)
    source = align(source, target.schema)
    columns = [quoted(name) for name in target.columns]
    # Not made distinct: an aggregate below the join would keep a hot key from being split.
    batch_keys = reject_null_keys(source.select(*map(quoted, keys)), keys)
    present = target.select(*map(quoted, keys))
    if broadcast_keys:
        batch_keys = F.broadcast(batch_keys)
        present = present.join(batch_keys, keys, "left_semi")
    kept = target.join(batch_keys, keys, "left_anti").select(*columns)
    count = unused_name(target.columns, "_matches")
    matches = present.groupBy(*map(quoted, keys)).agg(F.count("*").alias(count))
    placed = reject_null_keys(source, keys).join(matches, keys, "left")
    without_key = source.filter(any_null(keys))
    return kept.unionByName(_once_per_match(placed, keys, count, tasks).select(*columns)).unionByName(without_key)


def _once_per_match(placed: DataFrame, keys: list[str], count: str, tasks: int | None) -> DataFrame:
    """Each row as often as ``count`` says, and once where that is null.

    A key that a large part of the target shares is written by many tasks: its copies are cut
    into pieces, which are spread first. Nearly all rows are one piece.
    """
    piece, copy = unused_name(placed.columns, "_piece"), unused_name(placed.columns, "_copy")
    copies, key = F.coalesce(F.col(count), F.lit(1)), [F.col(quoted(name)) for name in keys]
    pieces = F.sequence(F.lit(0).cast("bigint"), F.floor((copies - 1) / COPIES_PER_PIECE))
    cut = placed.withColumn(piece, F.explode(pieces))
    if tasks is None:
        spread = cut.hint("rebalance", *key, F.col(piece))
    else:
        spread = cut.repartitionById(tasks, F.pmod(F.hash(*key) + F.col(piece), F.lit(tasks)).cast("int"))
    left = F.least(copies - F.col(piece) * COPIES_PER_PIECE, F.lit(COPIES_PER_PIECE))
    return spread.withColumn(copy, F.explode(F.sequence(F.lit(1).cast("bigint"), left)))


def time_of(column: Column, data_type: T.DataType) -> Column:
    """The column as a time; text is parsed, and null where it names none."""
    return iso_timestamp(column) if isinstance(data_type, T.StringType) else column


def not_older(
    batch: DataFrame,
    target: DataFrame,
    keys: list[str],
    order: list[str],
    broadcast_keys: bool = False,
    times: Iterable[str] = (),
    level: bool = True,
) -> DataFrame:
    """The rows of ``batch`` (one per key) that no row of ``target`` with their key comes after.

    Without ``level``, rows that a row of the target is level with are left out too. A null in ``order`` comes before every value. Columns named in ``times`` are compared as times
    even where they are text, and a text that names no time counts as null. With
    ``broadcast_keys``, for which ``keys_fit_broadcast`` must hold, only target rows with a key of
    the batch are shuffled.
    """
    types = {field.name.lower(): field.dataType for field in target.schema}
    times = {name.lower() for name in times}

    def place(prefix: str) -> Column:
        columns = []
        for name in order:
            data_type = types[name.lower()]
            column = F.col(f"{prefix}.{quoted(name)}").cast(data_type)
            columns.append(time_of(column, data_type) if name.lower() in times else column)
        return F.struct(*[part for column in columns for part in (column.isNotNull(), column)])

    def typed(name: str) -> Column:
        return F.col(quoted(name)).cast(types[name.lower()]).alias(name)

    if broadcast_keys:
        target = target.join(F.broadcast(batch.select(*map(typed, keys))), keys, "left_semi")
    same = [F.col(f"b.{quoted(key)}").cast(types[key.lower()]) == F.col(f"t.{quoted(key)}") for key in keys]
    later = place("t") > place("b") if level else place("t") >= place("b")
    return batch.alias("b").join(target.alias("t"), [*same, later], "left_anti")


def check_cardinality(target: DataFrame, source: DataFrame, keys: Iterable[str]) -> None:
    """Raise when a key occurs twice in the batch and exists in the target.

    Repeated keys are searched in the batch alone first; the target is read only if there are any.
    """
    keys = list(keys)
    rows = unused_name(keys, "_rows")
    repeated = (
        reject_null_keys(source.select(*map(quoted, keys)), keys)
        .groupBy(*map(quoted, keys))
        .agg(F.count("*").alias(rows))
        .filter(F.col(rows) > 1)
        .drop(rows)
    )
    if repeated.isEmpty():
        return
    example = target.select(*map(quoted, keys)).join(repeated, keys, "left_semi").first()
    if example is not None:
        raise MergeCardinalityError(f"several rows of the batch match the target row with key {example.asDict()}")
