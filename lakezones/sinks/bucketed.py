"""Parquet tables bucketed by key: a merge moves the batch to the buckets, not the table to the batch."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable
from itertools import accumulate

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakezones.fixed_values import TARGET_FILE_BYTES
from lakezones.operators.merge import align, check_cardinality, keys_fit_broadcast, merge_frames
from lakezones.session import stage
from lakezones.sinks.tables import Name, new_folder, set_location, table_description, table_location
from lakezones.sources.discovery import data_files
from lakezones.sources.tables import read_table
from lakezones.specs import quoted, quoted_table, unused_name

log = logging.getLogger(__name__)

# A bucket this many times larger than the average, and larger than a file should be, is hot. The average is over
# all buckets: of few keys, each with a large part of the rows, most buckets are empty.
HOT_BUCKET = 2
# Rows that one task sorts and writes. Not bytes: equal rows are small in files and shuffles, but not in a sort.
ROWS_PER_TASK = 1_000_000
# How Spark names the file of a bucket.
BUCKET_OF_FILE = r"_(\d{5})(?:\.[^/]*)?$"


def create_bucketed(df: DataFrame, table: Name, keys: Iterable[str], buckets: int, staged: bool = False) -> None:
    """Create ``table`` with the rows of ``df``, bucketed and sorted by ``keys``.

    A bucket is one file; one of more than ``ROWS_PER_TASK`` rows is written by several tasks, and has as many files.
    ``df`` is read twice, first for the rows of its buckets. ``staged`` says that it is made of rows of files, without
    a shuffle; otherwise it is written to the shared folder before large buckets are dealt out.
    """
    keys = list(keys)
    _save(_by_bucket(df, keys, buckets, staged), quoted_table(table), keys, buckets, new_folder(df.sparkSession, table))


def bucketing(spark: SparkSession, table: Name) -> tuple[int, list[str]] | None:
    """The number of buckets and the columns they are made of; None if the table has none."""
    found = dict(table_description(spark, table))
    if "Num Buckets" not in found:
        return None
    names = found["Bucket Columns"].strip("[]").split(", ")
    return int(found["Num Buckets"]), [name.strip("`") for name in names]


def bucket_sizes(spark: SparkSession, table: Name) -> DataFrame:
    """bucket and bytes of every bucket that has files."""
    files = data_files(spark, table_location(spark, table))
    return files.groupBy(F.regexp_extract("path", BUCKET_OF_FILE, 1).cast("int").alias("bucket")).agg(
        F.sum("length").alias("bytes")
    )


def has_hot_bucket(spark: SparkSession, table: Name, buckets: int, least_bytes: int = TARGET_FILE_BYTES) -> bool:
    """Whether one bucket is much larger than the others, as one key with very many rows makes it."""
    most, total = bucket_sizes(spark, table).agg(F.max("bytes"), F.sum("bytes")).first()
    return most is not None and most > max(least_bytes, HOT_BUCKET * total / buckets)


def merge_bucketed(
    batch: DataFrame, table: Name, keys: Iterable[str], staged: bool = False, unique: bool = False,
    hot_bytes: int = TARGET_FILE_BYTES,
) -> None:
    """Upsert ``batch`` into a table that is bucketed by ``keys``; same result as ``merge_or_create``.

    The batch is dealt out to the buckets and joined with them where they are. The table is read once,
    is not shuffled, and its new content has its buckets again. A bucket is one task, so
    a table with a hot bucket, by the size of its files, is merged through a shuffle instead, which
    spreads the rows of a key over many tasks. As when it is created, a bucket of more than ``ROWS_PER_TASK`` rows then
    consists of several files.
    """
    spark, keys = batch.sparkSession, list(keys)
    target = read_table(spark, table)
    found = None if target is None else bucketing(spark, table)
    if found is None or sorted(map(str.lower, found[1])) != sorted(map(str.lower, keys)):
        raise ValueError(f"{quoted_table(table)} is no table bucketed by {keys}")
    buckets, columns = found
    batch = align(batch, target.schema)
    if not staged:
        batch = stage(batch, "merge-batch")
    if not unique:
        check_cardinality(target, batch, keys)
    if has_hot_bucket(spark, table, buckets, hot_bytes):
        log.warning("%s has a hot bucket and is merged by a shuffle", quoted_table(table))
        merged = _merge_by_shuffle(batch, table, target, columns, buckets)
    else:
        merged = merged_by_bucket(target, batch, columns, buckets)
    _switch_buckets(merged, table, columns, buckets)


def merged_by_bucket(target: DataFrame, batch: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """One full join on the keys: a row of the batch where there is one, else the row of the target.

    A row of the batch that matches several target rows replaces each of them. Null keys match nothing, so that
    such rows of both sides stay.
    """
    new = unused_name(target.columns, "_new")
    dealt = batch.repartition(buckets, *map(quoted, keys)).withColumn(new, F.lit(True)).alias("b")
    same = [F.col(f"t.{quoted(key)}") == F.col(f"b.{quoted(key)}") for key in keys]
    joined = target.alias("t").join(dealt, same, "full_outer")
    matched = F.col(f"b.{quoted(new)}").isNotNull()
    return joined.select(
        *[
            F.when(matched, F.col(f"b.{quoted(name)}")).otherwise(F.col(f"t.{quoted(name)}")).alias(name)
            for name in target.columns
        ]
    )


def _merge_by_shuffle(batch: DataFrame, table: Name, target: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    spark = batch.sparkSession
    # Read as plain files: a scan by bucket would give the hot one to a single task.
    files = spark.read.schema(target.schema).parquet(table_location(spark, table))
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    merged = stage(merge_frames(files, batch, keys, keys_fit_broadcast(batch, keys), tasks), "merged")
    return _by_bucket(merged, keys, buckets, staged=True)


def _by_bucket(df: DataFrame, keys: list[str], buckets: int, staged: bool) -> DataFrame:
    """The rows of a bucket in one task; those of one with more than ``ROWS_PER_TASK`` rows dealt out to several.

    They are dealt out at random, so that equal rows are spread too. A repeated task has to deal them out as before,
    so that they come from staged files, which give a task the same rows in the same order.
    """
    bucket, piece = unused_name(df.columns, "_bucket"), unused_name(df.columns, "_piece")
    number = F.pmod(F.hash(*[F.col(quoted(key)) for key in keys]), F.lit(buckets)).alias(bucket)
    sizes = df.groupBy(number).agg(F.ceil(F.count("*") / ROWS_PER_TASK).cast("int").alias(piece))
    large = dict(map(tuple, sizes.filter(F.col(piece) > 1).collect()))
    if not large:
        return df.repartition(buckets, *map(quoted, keys))
    # The first piece of a bucket has the number of the bucket, the others come behind all buckets.
    pieces = [large.get(i, 1) for i in range(buckets)]
    *second, tasks = accumulate((n - 1 for n in pieces), initial=buckets)
    rows = (df if staged else stage(df, "bucket-rows")).withColumn(bucket, number)
    dealt = rows.withColumn(piece, F.floor(F.rand(0) * F.lit(pieces)[F.col(bucket)]).cast("int"))
    task = F.when(F.col(piece) > 0, F.lit(second)[F.col(bucket)] + F.col(piece) - 1).otherwise(F.col(bucket))
    return dealt.repartitionById(tasks, task).select(*map(quoted, df.columns))


def _switch_buckets(df: DataFrame, table: Name, keys: list[str], buckets: int) -> None:
    """Write the content to a new folder, by an entry that is given up at once, and move the table to it."""
    spark, folder = df.sparkSession, new_folder(df.sparkSession, table)
    parts = [part.strip("`") for part in (table.split(".") if isinstance(table, str) else table)]
    made = quoted_table((*parts[:-1], f"{parts[-1]}_{uuid.uuid4().hex}"))
    _save(df, made, keys, buckets, folder)
    spark.sql(f"DROP TABLE {made}")
    set_location(spark, table, folder)


def _save(df: DataFrame, name: str, keys: list[str], buckets: int, folder: str) -> None:
    writer = df.write.format("parquet").option("compression", "snappy").bucketBy(buckets, *keys).sortBy(*keys)
    writer.option("path", folder).saveAsTable(name)
