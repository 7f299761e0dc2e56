"""Put the small files of a Parquet table together."""

from __future__ import annotations

import logging
import re
from dataclasses import dataclass
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakezones.fixed_values import TARGET_FILE_BYTES
from lakezones.session import stage
from lakezones.sinks.tables import LISTED_PARTITIONS, Name, new_folder, partition_columns, set_location
from lakezones.sources.discovery import data_files
from lakezones.sources.tables import read_table
from lakezones.specs import quoted, quoted_table, sql_text, unused_name

log = logging.getLogger(__name__)

# A file below this share of the target size is small.
SMALL_SHARE = 0.75
# Fixed value: the folder of rows without a partition value.
NULL_PARTITION = "=__HIVE_DEFAULT_PARTITION__"


@dataclass(frozen=True)
class Compaction:
    """Files before and after, and the folders that were rewritten."""

    files_before: int = 0
    files_after: int = 0
    folders: int = 0


def packing(files: DataFrame, target_bytes: int) -> DataFrame:
    """folder, path, length and bin: the files of a folder, packed into bins of about the target size.

    Files are laid end to end, largest first, and a file belongs to the bin that it starts in. So a bin
    gets no more than the target and one file. Folders that would not get fewer files are left out.
    """
    order = Window.partitionBy("folder").orderBy(F.desc("length"), "path")
    before = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    placed = files.withColumn("bin", F.floor(F.coalesce(before, F.lit(0)) / target_bytes).cast("bigint"))
    whole = placed.groupBy("folder").agg(
        F.count("*").alias("files"), F.countDistinct("bin").alias("bins"),
        F.count_if(F.col("length") < SMALL_SHARE * target_bytes).alias("small"),
    )
    chosen = whole.filter((F.col("small") > 1) & (F.col("bins") < F.col("files"))).select("folder")
    return placed.join(chosen, "folder", "left_semi")


def compact_table(spark: SparkSession, table: Name, target_bytes: int = TARGET_FILE_BYTES) -> Compaction:
    """Rewrite the folders of ``table`` that hold several small files; the rows stay the same.

    A folder is the whole table, or one partition of it. Its new files are written next to it, whole
    old files into each, and the catalog is moved to them last, partition by partition: readers see
    the old or the new files, never both, and a run that fails changes nothing but partitions that it
    has finished. Folders with large files only, or with one small file, are not touched, nor is
    the partition of null. The files of the former content stay, as with every rewrite.
    """
    if read_table(spark, table) is None:
        return Compaction()
    name, partitions = quoted_table(table), partition_columns(spark, table)
    # The listing that the scan of the table itself is made from; paths are encoded as in a scan.
    listed = [re.sub("^file:/+", "file:/", path) for path in spark.table(name).inputFiles()]
    if not listed:
        return Compaction()
    packed = stage(packing(_sized(spark, listed), target_bytes), "compact-packing")
    rewritten = packed.count()
    if not rewritten:
        return Compaction(len(listed), len(listed))
    # One row per new file.
    bins = packed.select("folder", "bin").distinct()
    tasks = bins.count()
    numbered = bins.withColumn("task", (F.row_number().over(Window.orderBy("folder", "bin")) - 1).cast("int"))
    folder = new_folder(spark, table)
    _rewrite(spark.table(name), partitions, packed.join(numbered, ["folder", "bin"]), rewritten, tasks, folder)
    folders = [row.folder for row in packed.select("folder").distinct().collect()]
    rows, found = _rows_below(spark, folders), _rows_below(spark, [folder])
    if found != rows:
        raise RuntimeError(f"{name}: {found} rows were written of {rows}; the table is as it was")
    written = data_files(spark, folder)
    if partitions:
        for path in sorted(row[0] for row in written.select(folder_of("path")).distinct().collect()):
            spec = ", ".join(f"{quoted(key)} = {sql_text(value)}" for key, value in partition_values(path, partitions))
            spark.sql(f"ALTER TABLE {name} PARTITION ({spec}) SET LOCATION {sql_text(path)}")
        spark.catalog.refreshTable(name)
    else:
        set_location(spark, table, folder)
    after = len(listed) - rewritten + written.count()
    log.info("%s: %d files became %d", name, len(listed), after)
    return Compaction(len(listed), after, len(folders))


def _rows_below(spark: SparkSession, folders: list[str]) -> int:
    """Rows of all files in the folders, from their footers."""
    return spark.read.option("recursiveFileLookup", True).parquet(*folders).count()


def folder_of(path: str) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def partition_values(path: str, partitions: list[str]) -> list[tuple[str, str]]:
    """The partition columns and values that the last steps of a folder name."""
    steps = path.rstrip("/").split("/")[-len(partitions) :]
    return [(key, unquote(value)) for key, _, value in (step.partition("=") for step in steps)]


def _sized(spark: SparkSession, listed: list[str]) -> DataFrame:
    """folder, path and length of the listed files, without those of a partition of null."""
    plain = [unquote(path) for path in listed]
    named = spark.createDataFrame(list(zip(listed, plain)), "path string, plain string")
    sizes = data_files(spark, sorted({path.rsplit("/", 1)[0] for path in plain})).select(
        F.regexp_replace("path", "^file:/+", "file:/").alias("plain"), "length"
    )
    known = named.withColumn("plain", F.regexp_replace("plain", "^file:/+", "file:/")).join(sizes, "plain")
    return known.filter(~F.contains("plain", F.lit(NULL_PARTITION))).select(folder_of("plain").alias("folder"), "path", "length")


def _rewrite(
    rows: DataFrame, partitions: list[str], chosen: DataFrame, count: int, tasks: int, folder: str
) -> None:
    """Write the rows of the chosen files below ``folder``, those of a bin as one task."""
    path, task = unused_name(rows.columns, "_path"), unused_name(rows.columns, "_task")
    if count <= LISTED_PARTITIONS:
        # A literal list keeps the scan from opening any other file.
        rows = rows.filter(F.col("_metadata.file_path").isin([row.path for row in chosen.select("path").collect()]))
    places = chosen.select(F.col("path").alias(path), F.col("task").alias(task))
    placed = rows.withColumn(path, F.col("_metadata.file_path")).join(places, path)
    writer = placed.repartitionById(tasks, F.col(task)).drop(path, task).write.option("compression", "snappy")
    (writer.partitionBy(*partitions) if partitions else writer).parquet(folder)
