"""Tables of the catalog and Parquet datasets."""

from __future__ import annotations

import logging
import uuid
from collections.abc import Callable, Iterable
from typing import TypeVar

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakezones.specs import quoted, quoted_table, sql_text

log = logging.getLogger(__name__)
Found = TypeVar("Found")

MISSING = {"TABLE_OR_VIEW_NOT_FOUND", "SCHEMA_NOT_FOUND", "PATH_NOT_FOUND"}


def unless_missing(action: Callable[[], Found], otherwise: Found) -> Found:
    """``otherwise`` if the table or path does not exist; every other failure is raised."""
    try:
        return action()
    except AnalysisException as error:
        if (error.getCondition() or "").split(".")[0] not in MISSING:
            raise
        log.warning("not found: %s", error.getCondition())
        return otherwise


def read_table(spark: SparkSession, name: str | tuple[str, ...]) -> DataFrame | None:
    """The whole table, or None if there is no such table.

    The catalog entry is refreshed first: another session, such as that of a stream, may have
    moved the table to new files since this session last read it.
    """

    def read() -> DataFrame:
        spark.catalog.refreshTable(quoted_table(name))
        return spark.table(quoted_table(name))

    return unless_missing(read, None)


def table_exists(spark: SparkSession, name: str | tuple[str, ...]) -> bool:
    return read_table(spark, name) is not None


def table_row_count(spark: SparkSession, name: str | tuple[str, ...]) -> int:
    """Rows of a table; 0 if there is no such table."""
    table = read_table(spark, name)
    return 0 if table is None else table.count()


def parquet_row_count(spark: SparkSession, path: str) -> int:
    """Rows of a Parquet dataset, taken from the file footers; 0 if there is no such path."""
    return unless_missing(lambda: spark.read.parquet(path).count(), 0)


def register_dataset(
    spark: SparkSession,
    name: str | tuple[str, ...],
    path: str,
    partition_columns: tuple[str, ...] = (),
    schema: T.StructType | None = None,
) -> DataFrame:
    """Register the Parquet files below ``path`` as a table with the columns of all files combined.

    Run it again after files were added or removed: new columns and partitions appear,
    partitions whose files are gone disappear, and the data itself is never touched. The entry
    stays while it changes; only if the type of a column, the partitioning or the path is another
    one, a new one is made, and takes the place of the old one when it is complete. A managed table
    is refused, as its data would go with its entry. ``schema`` states the columns where they are
    known; files may hold narrower types.
    """
    table = quoted_table(name)
    if schema is None:
        schema = spark.read.option("mergeSchema", True).parquet(path).schema
    new = _new_fields(spark, table, schema, path, partition_columns)
    if new is None:
        _create_external(spark, name, schema, path, partition_columns)
    elif new:
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({_columns(new)})")
    spark.catalog.refreshTable(table)
    if partition_columns:
        spark.sql(f"MSCK REPAIR TABLE {table} SYNC PARTITIONS")
    return spark.table(table)


def _create_external(
    spark: SparkSession, name: str | tuple[str, ...], schema: T.StructType, path: str, partition_columns: tuple[str, ...]
) -> None:
    table, parts = quoted_table(name), [part.strip("`") for part in (name.split(".") if isinstance(name, str) else name)]
    partitioned = f" PARTITIONED BY ({', '.join(map(quoted, partition_columns))})" if partition_columns else ""
    made = quoted_table((*parts[:-1], f"{parts[-1]}_{uuid.uuid4().hex}"))
    spark.sql(f"CREATE TABLE {made} ({_columns(schema)}) USING parquet{partitioned} LOCATION {sql_text(path)}")
    spark.sql(f"DROP TABLE IF EXISTS {table}")
    spark.sql(f"ALTER TABLE {made} RENAME TO {table}")


def _columns(fields: Iterable[T.StructField]) -> str:
    return ", ".join(f"{quoted(field.name)} {type_text(field.dataType)}" for field in fields)


def type_text(data_type: T.DataType) -> str:
    """The type as SQL, with quoted names of fields."""
    if isinstance(data_type, T.StructType):
        return f"struct<{', '.join(f'{quoted(field.name)}: {type_text(field.dataType)}' for field in data_type)}>"
    if isinstance(data_type, T.ArrayType):
        return f"array<{type_text(data_type.elementType)}>"
    if isinstance(data_type, T.MapType):
        return f"map<{type_text(data_type.keyType)}, {type_text(data_type.valueType)}>"
    return data_type.simpleString()


def _new_fields(
    spark: SparkSession, table: str, schema: T.StructType, path: str, partition_columns: tuple[str, ...]
) -> list[T.StructField] | None:
    """The columns that the entry of ``table`` lacks; None if there is no entry or it cannot be kept."""
    if not spark.catalog.tableExists(table):
        return None
    if spark.catalog.getTable(table).tableType == "MANAGED":
        raise ValueError(f"{table} is a managed table; register its files under another name")
    described = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").collect()
    location = next((row["data_type"] for row in described if row["col_name"] == "Location"), "")
    partitions = tuple(column.name for column in spark.catalog.listColumns(table) if column.isPartition)
    if (plain_path(location), partitions) != (plain_path(path), tuple(partition_columns)):
        return None
    known = {field.name.lower(): field.dataType for field in spark.table(table).schema}
    if any(type_text(known.get(field.name.lower(), field.dataType)) != type_text(field.dataType) for field in schema):
        return None
    return [field for field in schema if field.name.lower() not in known]


def plain_path(path: str) -> str:
    """The path as one form of writing it; local paths may come with or without their scheme."""
    return "/" + path.removeprefix("file:").strip("/") if path.startswith(("file:", "/")) else path.rstrip("/")
