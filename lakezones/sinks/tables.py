"""Write a zone table: merge, overwrite or append, and create it when it is missing.

Tables of a format with row-level operations are changed by that format. Plain Parquet tables
cannot be changed in place, so their new content is written to a new folder first, and the
catalog entry is moved to it last: readers see the old or the new content, and a failed write
changes nothing. Partitions that are overwritten are the exception: they are replaced in place,
one after another. The old folder stays until the storage's life-cycle rule removes it.
"""

from __future__ import annotations

import logging
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakezones.fixed_values import PARTITION_COLUMN, TARGET_FILE_BYTES
from lakezones.operators.merge import align, check_cardinality, keys_fit_broadcast, merge_frames
from lakezones.session import stage
from lakezones.sources.tables import read_table
from lakezones.specs import merge_condition, quoted, quoted_table, sql_text, unused_name

log = logging.getLogger(__name__)

# Partition values that a merge lists to prune its scan.
LISTED_PARTITIONS = 10_000

Name = str | tuple[str, ...]

# Formats whose tables take MERGE and overwrite by themselves. Their jars are not part of Spark,
# so this branch is not covered by the tests.
ROW_LEVEL_FORMATS = {"iceberg", "delta"}


def merge_or_create(
    batch: DataFrame,
    table: Name,
    keys: Iterable[str],
    provider: str = "parquet",
    partition_column: str | None = None,
    staged: bool = False,
    unique: bool = False,
    location: str | None = None,
) -> None:
    """Upsert ``batch`` into ``table`` on ``keys``; create the table, at ``location``, when it is missing.

    ``staged`` says that the batch is cheap to read several times, as a table is; otherwise it
    is written once to the shared folder first. ``unique`` says that no key repeats in the batch, as
    after a deduplication, so that this is not checked again. A Parquet table that is partitioned by one of
    its keys only has the partitions rewritten that the batch touches.
    """
    spark, keys = batch.sparkSession, list(keys)
    target = read_table(spark, table)
    if target is None:
        create_table(batch, table, provider, partition_column, location)
        return
    if _provider(spark, table) in ROW_LEVEL_FORMATS:
        spark.sql(
            f"MERGE INTO {quoted_table(table)} AS old USING {{batch}} AS new ON {merge_condition(keys)}"
            " WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *",
            batch=align(batch, target.schema),
        )
        return
    # Cast first: keys that differ as text may be equal in the target.
    batch = align(batch, target.schema)
    if not staged:
        batch = stage(batch, "merge-batch")
    partitions = partition_columns(spark, table)
    if partitions:
        _merge_partitions(batch, target, table, keys, partitions, unique)
        return
    if not unique:
        check_cardinality(target, batch, keys)
    _switch_content(merge_frames(target, batch, keys, keys_fit_broadcast(batch, keys)), table)


def _merge_partitions(
    batch: DataFrame, target: DataFrame, table: Name, keys: list[str], partitions: list[str], unique: bool
) -> None:
    if len(partitions) != 1 or partitions[0].lower() not in (key.lower() for key in keys):
        raise ValueError(f"a partitioned Parquet table merges only if its one partition column is a key: {partitions}")
    # A match has the same partition value, so no other partition can change.
    current = _touched(target, batch, partitions[0])
    if not unique:
        check_cardinality(current, batch, keys)
    _overwrite_partitions(merge_frames(current, batch, keys, keys_fit_broadcast(batch, keys)), table)


def _touched(target: DataFrame, batch: DataFrame, partition: str) -> DataFrame:
    """The rows of the partitions that the batch has rows of.

    Up to ``LISTED_PARTITIONS`` values become a literal list, which prunes the scan whatever the
    sizes are; with more the values are joined, and Spark prunes by them as it runs.
    """
    column = F.col(quoted(partition))
    values = batch.select(column).distinct()
    listed = [row[0] for row in values.limit(LISTED_PARTITIONS + 1).collect()]
    if len(listed) <= LISTED_PARTITIONS:
        touched = column.isin([value for value in listed if value is not None])
        return target.filter(touched | column.isNull() if None in listed else touched)
    name = unused_name(target.columns, "_partition")
    return target.join(values.withColumnRenamed(partition, name), column.eqNullSafe(F.col(name)), "left_semi")


def overwrite_or_create(df: DataFrame, table: Name, provider: str = "parquet") -> None:
    """Replace all rows of ``table``; create it when it is missing."""
    spark = df.sparkSession
    target = read_table(spark, table)
    if target is None:
        create_table(df, table, provider)
    elif _provider(spark, table) in ROW_LEVEL_FORMATS:
        df.writeTo(quoted_table(table)).overwrite(F.lit(True))
    elif partition_columns(spark, table):
        # The catalog knows each partition's folder, so these are replaced in place; the rows are
        # staged as they may come from the table itself.
        _insert_overwrite(stage(align(df, target.schema), "overwrite"), table, "static")
    else:
        _switch_content(align(df, target.schema), table)


def append_partitions(
    df: DataFrame,
    table: Name,
    partition_column: str = PARTITION_COLUMN,
    replace: bool = False,
    provider: str = "parquet",
    empty: bool | None = None,
) -> bool:
    """Append under the partition of the rows; new columns and partitions enter the catalog.

    Nothing is written for an empty frame; ``empty`` says so where it is known. ``replace``
    overwrites the partitions that the frame holds, so that a second run of the same day does not
    double its rows. The rows of a partition are brought together first, and cut into files of
    about the target size.
    """
    spark = df.sparkSession
    if not df.columns or (df.isEmpty() if empty is None else empty):
        return False
    target = read_table(spark, table)
    if target is None:
        create_table(df, table, provider, partition_column)
        return True
    known = {name.lower() for name in target.columns}
    new = [field for field in df.schema if field.name.lower() not in known]
    if new:
        columns = ", ".join(f"{quoted(field.name)} {field.dataType.simpleString()}" for field in new)
        spark.sql(f"ALTER TABLE {quoted_table(table)} ADD COLUMNS ({columns})")
    schema = spark.table(quoted_table(table)).schema
    present = {name.lower() for name in df.columns}
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema if f.name.lower() not in present}
    rows = align(df.withColumns(absent) if absent else df, schema)
    if _provider(spark, table) in ROW_LEVEL_FORMATS:
        writer = rows.writeTo(quoted_table(table))
        writer.overwritePartitions() if replace else writer.append()
    elif replace:
        _overwrite_partitions(rows, table)
    else:
        partitions = partition_columns(spark, table)
        (_by_partition(rows, partitions) if partitions else rows).write.insertInto(quoted_table(table))
    return True


def create_table(
    df: DataFrame, table: Name, provider: str = "parquet", partition_column: str | None = None, location: str | None = None
) -> None:
    """Create ``table`` with the rows of ``df`` at ``location``, by default below that of its database."""
    name = quoted_table(table)
    if provider in ROW_LEVEL_FORMATS:
        writer = (
            df.writeTo(name)
            .using(provider)
            .tableProperty("write.format.default", "parquet")
            .tableProperty("write.parquet.compression-codec", "snappy")
            .tableProperty("target-file-size-bytes", str(TARGET_FILE_BYTES))
        )
        if location:
            writer = writer.tableProperty("location", location)
        (writer.partitionedBy(F.col(partition_column)) if partition_column else writer).create()
        return
    writer = df.write.format("parquet").option("compression", "snappy")
    if partition_column:
        writer = _by_partition(df, [partition_column]).write.format("parquet").option("compression", "snappy")
        writer = writer.partitionBy(partition_column)
    writer.option("path", location or new_folder(df.sparkSession, table)).saveAsTable(name)


def _by_partition(df: DataFrame, partitions: list[str]) -> DataFrame:
    """The rows of a partition value together, so that it gets few files; many rows are split by size."""
    return df.hint("rebalance", *[F.col(quoted(name)) for name in partitions])


def _switch_content(df: DataFrame, table: Name) -> None:
    """Write the whole content to a new folder and move the table to it."""
    folder = new_folder(df.sparkSession, table)
    df.write.option("compression", "snappy").parquet(folder)
    set_location(df.sparkSession, table, folder)


def set_location(spark: SparkSession, table: Name, folder: str) -> None:
    """Move the catalog entry of a table to another folder."""
    spark.sql(f"ALTER TABLE {quoted_table(table)} SET LOCATION {sql_text(folder)}")
    spark.catalog.refreshTable(quoted_table(table))


def _overwrite_partitions(df: DataFrame, table: Name) -> None:
    """Replace the partitions that ``df`` holds rows of; the others stay."""
    _insert_overwrite(df, table, "dynamic")


def _insert_overwrite(df: DataFrame, table: Name, kind: str) -> None:
    """Overwrite all partitions (static) or those of the rows (dynamic), whatever the session says."""
    spark, setting = df.sparkSession, "spark.sql.sources.partitionOverwriteMode"
    mode = spark.conf.get(setting)
    spark.conf.set(setting, kind)
    try:
        rows = _by_partition(df, partition_columns(spark, table))
        rows.write.insertInto(quoted_table(table), overwrite=True)
    finally:
        spark.conf.set(setting, mode)


def new_folder(spark: SparkSession, table: Name) -> str:
    """A folder for new content of ``table``, below the location of its database."""
    parts = table.split(".") if isinstance(table, str) else list(table)
    database = parts[-2].strip("`") if len(parts) > 1 else spark.catalog.currentDatabase()
    location = spark.catalog.getDatabase(quoted(database)).locationUri.rstrip("/")
    return f"{location}/{parts[-1].strip('`')}/content-{uuid.uuid4().hex}"


def table_description(spark: SparkSession, table: Name) -> list[tuple[str, str]]:
    """What the catalog says of ``table``, as pairs of name and value."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {quoted_table(table)}").collect()
    return [(row["col_name"], row["data_type"]) for row in rows]


def table_location(spark: SparkSession, table: Name) -> str:
    """The folder that holds the content of ``table`` now."""
    return next(value for name, value in table_description(spark, table) if name == "Location")


def _provider(spark: SparkSession, table: Name) -> str:
    return next((value.lower() for name, value in table_description(spark, table) if name == "Provider"), "")


def partition_columns(spark: SparkSession, table: Name) -> list[str]:
    """The columns that ``table`` is partitioned by."""
    names = [name for name, _ in table_description(spark, table)]
    if "# Partition Information" not in names:
        return []
    start = names.index("# Partition Information") + 2
    return [name for name in names[start : names.index("", start)]]
