"""Keep the latest record per key."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakezones.functions.casts import iso_timestamp
from lakezones.specs import quoted, unused_name

METHODS = ("row_number", "dense_rank")


def deduplicate_latest(
    df: DataFrame,
    key: str | Iterable[str],
    order: str,
    method: str = "row_number",
    ties: Iterable[str] = (),
    times: Iterable[str] = (),
) -> DataFrame:
    """Per key, the row (``row_number``) or all rows (``dense_rank``) with the greatest order value.

    Null keys form one group, null order values come last. ``ties`` names further columns,
    greatest first, that settle which of several latest rows ``row_number`` keeps. Columns named in
    ``times`` are compared as times where they are text, and a text that names no time counts as null.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ties = list(ties)
    known = {name.lower() for name in df.columns}
    missing = [name for name in [*keys, order, *ties] if name.lower() not in known]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if method not in METHODS:
        raise ValueError(f"unknown method {method!r}, choose one of {METHODS}")
    as_text = {name.lower() for name in times} & {f.name.lower() for f in df.schema if isinstance(f.dataType, T.StringType)}
    parsed = {
        name: unused_name(df.columns, f"_time{i}") for i, name in enumerate([order, *ties]) if name.lower() in as_text
    }
    timed = df.withColumns({scratch: iso_timestamp(F.col(quoted(name))) for name, scratch in parsed.items()}) if parsed else df
    if method == "row_number":
        latest = _first_row(timed, keys, [parsed.get(name, name) for name in [order, *ties]])
    else:
        latest = _all_latest(timed, keys, parsed.get(order, order))
    return latest.drop(*parsed.values())


def _first_row(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    # The filter on the rank lets Spark cut each key to one row per task before the shuffle,
    # so a key with a third of all rows sends no more rows than there are tasks.
    rank = unused_name(df.columns, "_rank")
    latest = Window.partitionBy(*map(quoted, keys)).orderBy(*[F.col(quoted(c)).desc_nulls_last() for c in order])
    return df.withColumn(rank, F.row_number().over(latest)).filter(F.col(rank) == 1).drop(rank)


def _all_latest(df: DataFrame, keys: list[str], order: str) -> DataFrame:
    # All tied rows stay, and one key may own most of them: a window would gather them in one
    # task. The greatest value per key is a small pre-aggregated table instead; the semi join
    # against it broadcasts when it fits and is split by the adaptive skew join when it does not.
    top = unused_name(df.columns, "_top")
    names = [unused_name(df.columns, f"_key{i}") for i in range(len(keys))]
    tops = df.groupBy(*[F.col(quoted(k)).alias(name) for k, name in zip(keys, names)]).agg(
        F.max(quoted(order)).alias(top)
    )
    match = F.col(quoted(order)).eqNullSafe(F.col(top))
    for k, name in zip(keys, names):
        match = match & F.col(quoted(k)).eqNullSafe(F.col(name))
    return df.join(tops, match, "left_semi")


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return df.groupBy(*map(quoted, keys)).agg(F.count("*").alias("rows")).filter("rows > 1")
