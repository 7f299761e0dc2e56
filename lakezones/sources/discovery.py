"""Find the tables below a location, combine the schemas of their files, and keep the catalog in step."""

from __future__ import annotations

import logging
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakezones.sources.tables import plain_path, register_dataset, unless_missing
from lakezones.specs import quoted_table, sql_text

log = logging.getLogger(__name__)

# The property of a catalog entry that says which location it was found below.
FOUND_BELOW = "lakezones.found_below"
AT_ONCE = 16

# Whole number types by width, and the decimal digits that hold each.
WHOLE_NUMBERS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}
MOST_DIGITS = 38


class IncompatibleTypes(ValueError):
    """Two files hold a column in types that no type holds without loss."""


def combine_types(left: T.DataType, right: T.DataType, name: str = "") -> T.DataType:
    """The least type that holds all values of both: wider numbers, structs with the fields of both.

    Whole numbers fit into wider ones, into decimals, and up to 32 bits into doubles; floats fit into
    doubles, decimals into decimals with as many digits on both sides of the point, and days into
    times without zone.
    """
    if left == right or isinstance(right, T.NullType):
        return left
    if isinstance(left, T.NullType):
        return right
    if isinstance(left, T.StructType) and isinstance(right, T.StructType):
        return combine_schemas(left, right, name)
    if isinstance(left, T.ArrayType) and isinstance(right, T.ArrayType):
        return T.ArrayType(combine_types(left.elementType, right.elementType, f"{name}[]"), True)
    if isinstance(left, T.MapType) and isinstance(right, T.MapType):
        keys = combine_types(left.keyType, right.keyType, f"{name} key")
        return T.MapType(keys, combine_types(left.valueType, right.valueType, f"{name} value"), True)
    if {type(left), type(right)} == {T.DateType, T.TimestampNTZType}:
        return T.TimestampNTZType()
    combined = _combine_numbers(left, right)
    if combined is None:
        raise IncompatibleTypes(f"column {name}: {left.simpleString()} and {right.simpleString()}")
    return combined


def _combine_numbers(left: T.DataType, right: T.DataType) -> T.DataType | None:
    kinds = {type(left), type(right)}
    whole = [kind for kind in WHOLE_NUMBERS if kind in kinds]
    if len(whole) == 2:
        return whole[-1]()
    if kinds <= {*WHOLE_NUMBERS, T.DecimalType}:
        sizes = [
            (one.precision - one.scale, one.scale) if isinstance(one, T.DecimalType) else (WHOLE_NUMBERS[type(one)], 0)
            for one in (left, right)
        ]
        before, after = (max(pair) for pair in zip(*sizes))
        return T.DecimalType(before + after, after) if before + after <= MOST_DIGITS else None
    if T.LongType not in kinds and kinds <= {*WHOLE_NUMBERS, T.FloatType, T.DoubleType}:
        return T.DoubleType()
    return None


def combine_schemas(left: T.StructType, right: T.StructType, name: str = "") -> T.StructType:
    """The columns of both, matched without regard to case; those only in ``right`` come last."""
    found = {field.name.lower(): field for field in right}
    fields = []
    for field in left:
        other = found.pop(field.name.lower(), None)
        at = f"{name}.{field.name}" if name else field.name
        data_type = field.dataType if other is None else combine_types(field.dataType, other.dataType, at)
        fields.append(T.StructField(field.name, data_type))
    return T.StructType(fields + [T.StructField(field.name, field.dataType) for field in found.values()])


def data_files(spark: SparkSession, location: str | list[str], pattern: str = "*.parquet") -> DataFrame:
    """path and length of every file below the location or locations; the content is not read."""
    reader = spark.read.format("binaryFile").options(recursiveFileLookup=True, pathGlobFilter=pattern)
    return reader.load(location).select("path", "length")


def table_files(spark: SparkSession, location: str, level: int = 1) -> DataFrame:
    """table, folder, path, length and the partition columns of every data file.

    A table is the folder ``level`` steps below ``location``, named by these steps. Folders below it
    that look like ``name=value`` are its partitions. Files that lie higher belong to no table.
    """
    root = plain_path(location)
    plain = F.regexp_replace("path", "^file:/+", "/")
    parts = F.split(F.substr(plain, F.lit(len(root) + 2)), "/")
    below = F.slice(parts, level + 1, F.greatest(F.size(parts) - (level + 1), F.lit(0)))
    partitions = F.transform(F.filter(below, lambda step: F.contains(step, F.lit("="))), lambda step: F.split_part(step, F.lit("="), F.lit(1)))
    return (
        data_files(spark, location)
        .withColumn("parts", parts)
        .filter(F.size("parts") > level)
        .select(
            F.array_join(F.slice("parts", 1, level), "_").alias("table"),
            F.concat(F.lit(root + "/"), F.array_join(F.slice("parts", 1, level), "/")).alias("folder"),
            F.regexp_replace("path", "/[^/]*$", "").alias("part"),
            "path",
            "length",
            partitions.alias("partitions"),
        )
    )


def combined_schema(spark: SparkSession, folder: str, files: DataFrame) -> T.StructType:
    """The schema of all files of a table, partition columns last.

    Spark combines equal types in one job over all footers. Only where types differ are the folders
    looked at one by one, and in a folder whose own files differ its files by halves. ``files`` has
    the columns ``part`` and ``path``.
    """

    def read(paths: list[str]) -> T.StructType | None:
        try:
            return spark.read.options(mergeSchema=True, basePath=folder).parquet(*paths).schema
        except (PySparkException, Py4JJavaError) as error:
            # A type that differs is no analysis error, so it comes as an exception of the JVM.
            if "CANNOT_MERGE" not in str(error):
                raise
            return None

    def halves(paths: list[str]) -> T.StructType:
        found = read(paths)
        if found is not None:
            return found
        middle = len(paths) // 2
        return combine_schemas(halves(paths[:middle]), halves(paths[middle:]))

    def part_schema(part: str) -> T.StructType:
        found = read([part])
        if found is not None:
            return found
        return halves([row.path for row in files.filter(F.col("part") == part).select("path").orderBy("path").collect()])

    found = read([folder])
    if found is None:
        parts = [row.part for row in files.select("part").distinct().orderBy("part").collect()]
        with ThreadPoolExecutor(AT_ONCE) as pool:
            schemas = list(pool.map(part_schema, parts))
        found = schemas[0]
        for schema in schemas[1:]:
            found = combine_schemas(found, schema)
    return found


@dataclass(frozen=True)
class Discovered:
    """What was found of a table, and what became of its catalog entry: registered, dropped or failed."""

    name: str
    status: str
    files: int = 0
    bytes: int = 0
    problem: str = ""


def discover_tables(spark: SparkSession, location: str, database: str, level: int = 1) -> list[Discovered]:
    """Register every table below ``location`` in ``database``, and drop the entries of vanished ones.

    The files of a table may hold a column in several types, of which the least common one becomes
    the column's; Spark widens the values of each file as it reads it. A table whose files do not
    go together is left as it is and reported; the others are not stopped by it. Run it again after
    files were added, changed or removed. Only entries that this function made are ever dropped, and
    data never is.
    """
    files = unless_missing(lambda: table_files(spark, location, level).persist(), None)
    groups = [] if files is None else (
        files.groupBy("table", "folder")
        .agg(F.count("*").alias("files"), F.sum("length").alias("bytes"), F.collect_set("partitions").alias("partitions"))
        .orderBy("table")
        .collect()
    )
    try:
        with ThreadPoolExecutor(AT_ONCE) as pool:
            found = list(pool.map(lambda group: _register(spark, database, location, files, group), groups))
    finally:
        if files is not None:
            files.unpersist()
    return found + _drop_vanished(spark, database, location, {group.table.lower() for group in groups})


def _register(spark: SparkSession, database: str, location: str, files: DataFrame, group) -> Discovered:
    name = (database, group.table)
    try:
        if len(group.partitions) != 1:
            raise IncompatibleTypes(f"files lie in folders of different partitions: {sorted(group.partitions)}")
        own = files.filter((F.col("table") == group.table) & (F.col("folder") == group.folder))
        schema = combined_schema(spark, group.folder, own)
        register_dataset(spark, name, group.folder, tuple(group.partitions[0]), schema)
    except IncompatibleTypes as error:
        log.warning("table %s: %s", group.table, error)
        return Discovered(group.table, "failed", group.files, group.bytes, str(error))
    spark.sql(f"ALTER TABLE {quoted_table(name)} SET TBLPROPERTIES ({sql_text(FOUND_BELOW)} = {sql_text(plain_path(location))})")
    return Discovered(group.table, "registered", group.files, group.bytes)


def _drop_vanished(spark: SparkSession, database: str, location: str, present: set[str]) -> list[Discovered]:
    dropped = []
    for table in spark.catalog.listTables(database):
        if table.isTemporary or table.tableType != "EXTERNAL" or table.name.lower() in present:
            continue
        name = quoted_table((database, table.name))
        properties = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
        if properties.get(FOUND_BELOW) == plain_path(location):
            spark.sql(f"DROP TABLE {name}")
            dropped.append(Discovered(table.name, "dropped"))
    return dropped
