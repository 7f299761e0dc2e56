"""Delimited extracts, every column as text."""

from __future__ import annotations

from collections.abc import Iterable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakezones.fixed_values import CSV_NULL_TOKENS
from lakezones.specs import quoted, unused_name

HEADERS_AT_ONCE = 16

# The column that tells which rows do not fit their header.
REJECTED = "_rejected"
# Fields that are quoted as a whole or have no quotes.
FIELD = r'(?:"[^"]*+(?:""[^"]*+)*+"|[^",]*+)'
PLAIN_ROW = rf"^{FIELD}(?:,{FIELD})*+$"


def read_text_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: Iterable[str] | None = None,
    null_tokens: Iterable[str] = CSV_NULL_TOKENS,
    multi_line: bool = True,
) -> DataFrame:
    """Read CSV with a header; nothing is inferred, so leading zeros and the like survive.

    ``columns`` states the header where it is known, which saves reading it first. A file whose
    header differs from it, or from that of the first file, is an error: read such files as
    sources of their own. ``multi_line`` allows line breaks inside quotes; switch it off for extracts that have none
    and whose files are so large that one file should be read by several tasks.
    """
    reader = spark.read.options(header=True, inferSchema=False, enforceSchema=False, escape='"', multiLine=multi_line)
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(name, T.StringType()) for name in columns]))
    df = reader.csv(paths)
    return df.select(*_values(df.columns, null_tokens))


def _values(columns: Iterable[str], null_tokens: Iterable[str]) -> list[Column]:
    """The columns, null where they hold a text for "no value"."""
    tokens = list(null_tokens)
    if not tokens:
        return [F.col(quoted(name)) for name in columns]
    return [F.when(~F.col(quoted(name)).isin(tokens), F.col(quoted(name))).alias(name) for name in columns]


def read_checked_csv(
    spark: SparkSession,
    paths: str | list[str],
    columns: Iterable[str] | None = None,
    null_tokens: Iterable[str] = CSV_NULL_TOKENS,
    multi_line: bool = True,
    short_rows: bool = True,
    rejected: str = REJECTED,
) -> DataFrame:
    """Read CSV as ``read_text_csv`` does, with a column that tells which rows do not fit the header.

    ``rejected`` is null for a good row. For a row with more fields than the header it holds the
    file, the text of the row and both numbers of fields: no field is cut off silently. A row
    with fewer fields ends in nulls, as the extracts' readers have always had it; without
    ``short_rows`` it is rejected as well. So is, in any case, a row with quotes inside a plain
    field and another number of fields than the header, as its fields cannot be told apart.
    """
    if columns is None:
        columns = read_text_csv(spark, paths, null_tokens=(), multi_line=False).columns
    columns = list(columns)
    corrupt = unused_name(columns, "_corrupt")
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*columns, corrupt]])
    reader = spark.read.schema(schema).options(
        header=True, enforceSchema=False, escape='"', multiLine=multi_line, mode="PERMISSIVE",
        # A row is only known to be ragged if all of its fields are parsed.
        columnNameOfCorruptRecord=corrupt, columnPruning=False,
    )
    text = F.col(quoted(corrupt))
    plain = text.rlike(PLAIN_ROW)
    # Without quoted fields, separators are left only between fields.
    found = F.when(plain, F.regexp_count(F.regexp_replace(text, '"[^"]*"', ""), F.lit(",")) + 1)
    fits = plain & (found < len(columns)) if short_rows else F.lit(False)
    note = F.struct(
        F.col("_metadata.file_path").alias("source"), text.alias("text"), F.lit(len(columns)).alias("expected"),
        found.alias("found"),
    )
    # Always true; Spark does not read the text of bad rows without any of the columns.
    read = F.length(F.coalesce(F.col(quoted(columns[0])), F.lit(""))) >= 0
    df = reader.csv(paths)
    return df.select(*_values(columns, null_tokens), F.when(text.isNotNull() & ~fits & read, note).alias(rejected))


def accepted_rows(df: DataFrame, rejected: str = REJECTED) -> DataFrame:
    """The rows that fit their header."""
    return df.filter(F.col(quoted(rejected)).isNull()).drop(rejected)


def rejected_rows(df: DataFrame, rejected: str = REJECTED) -> DataFrame:
    """source, text, expected and found of the rows that do not fit their header."""
    return df.filter(F.col(quoted(rejected)).isNotNull()).select(f"{quoted(rejected)}.*")


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """All rows of all frames, columns matched by name, null where a frame lacks one.

    Frames without any column, as an empty extract gives, are left out.
    """
    frames = [frame for frame in frames if frame.columns]
    if not frames:
        raise ValueError("no frame has any column")
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def read_sources(
    spark: SparkSession,
    paths: Iterable[str],
    multi_line: bool = True,
    null_tokens: Iterable[str] = CSV_NULL_TOKENS,
    short_rows: bool = True,
) -> DataFrame:
    """Read the extracts of several sources whose headers may differ, with the column ``REJECTED``.

    Only the header of each source is read up front, several at a time. Sources with the same
    header share one scan, and the scans are put together by column name. No source at all, or
    only empty ones, gives a frame without columns.
    """
    paths = list(paths)

    def header(path: str) -> tuple[str, ...]:
        # Without multi_line only the first line of the first file is fetched.
        return tuple(read_text_csv(spark, path, null_tokens=(), multi_line=False).columns)

    by_header: dict[tuple[str, ...], list[str]] = {}
    with ThreadPoolExecutor(HEADERS_AT_ONCE) as pool:
        for path, columns in zip(paths, pool.map(header, paths)):
            if columns:
                by_header.setdefault(columns, []).append(path)
    if not by_header:
        return spark.createDataFrame([], T.StructType([]))
    return union_by_name(
        read_checked_csv(spark, group, columns, null_tokens, multi_line, short_rows) for columns, group in by_header.items()
    )
