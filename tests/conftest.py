import uuid

import pytest
from pyspark.sql import SparkSession

from lakezones import prepare_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("lakezones-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "4g")
        .config("spark.checkpoint.dir", str(folder / "shared"))
        .config("spark.sql.warehouse.dir", str(folder / "warehouse"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield prepare_session(session)
    session.stop()


@pytest.fixture
def database(spark, tmp_path):
    """A database of its own for each test."""
    name = "zone_" + uuid.uuid4().hex[:8]
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path / name}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def rows():
    """Rows of a frame as sorted tuples, null first."""

    def sort_key(row):
        return [(value is not None, str(value)) for value in row]

    def collect(df, *columns):
        return sorted((tuple(row) for row in (df.select(*columns) if columns else df).collect()), key=sort_key)

    return collect
