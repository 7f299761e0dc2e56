from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakezones import prepare_session
from lakezones.session import scratch_path
from lakezones.specs import sql_text

Query = Callable[["Tables"], DataFrame]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The given tables of one scale factor."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = prepare_session(spark)
        self.folder = folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, *names: str) -> DataFrame:
        """Run SQL that the checking engine can run as well over the named tables."""
        tables = ", ".join(f"{name} AS (SELECT * FROM parquet.`{self.folder}/{name}.parquet`)" for name in names)
        return self.spark.sql(f"WITH {tables} {text}")

    def path(self, label: str) -> str:
        """A new path in the shared folder."""
        return scratch_path(self.spark, label)

    def database(self) -> str:
        """A new database in the shared folder."""
        location = self.path("zone")
        name = "zone_" + location.rsplit("-", 1)[1]
        self.spark.sql(f"CREATE DATABASE {name} LOCATION {sql_text(location)}")
        return name


def query(oracle: str, name: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name or ``name``, with the SQL that gives the same rows."""

    def register(function: Query) -> Query:
        key = name or function.__name__
        QUERIES[key] = lambda spark, folder: function(Tables(spark, folder))
        ORACLES[key] = oracle.strip()
        return function

    return register


def ntz(df: DataFrame, *columns: str) -> DataFrame:
    """Times without zone, the type the checking engine gives."""
    return df.withColumns({name: df[name].cast("timestamp_ntz") for name in columns})
