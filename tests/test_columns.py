from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from lakezones.functions.casts import guarded_timestamp, iso_timestamp, numeric_key
from lakezones.operators.columns import (
    default_column,
    drop_payload,
    ingest_stamp,
    load_rename_map,
    parse_timestamps,
    partition_stamp,
    project,
    rename_columns,
    stringify_all,
)


def cast(spark, function, value):
    df = spark.createDataFrame([(value,)], "v string").select(function(F.col("v")).alias("v"))
    return df.first()[0]


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, None), ("7", 7), ("007", 7), (" 7 ", 7), ("-7", -7), ("1.0", 1), ("1e3", 1000), ("1.5", None),
        ("1.0000000001", None), ("x7", None), ("", None), ("9007199254740993", 9007199254740993),
        ("9223372036854775807", 9223372036854775807), ("9223372036854775808", None), ("1e30", None), ("nan", None),
    ],
)
def test_numeric_key(spark, text, expected):
    assert cast(spark, numeric_key, text) == expected


def test_numeric_key_of_numbers(spark):
    df = spark.sql("SELECT 5L AS a, 2.0D AS b, 2.5D AS c")
    assert tuple(df.select(*[numeric_key(F.col(c)) for c in "abc"]).first()) == (5, 2, None)


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, None),
        ("2024-01-02T03:04:05Z", datetime(2024, 1, 2, 3, 4, 5)),
        ("2024-01-02T03:04:05.250Z", datetime(2024, 1, 2, 3, 4, 5, 250000)),
        ("2024-01-02T03:04:05+02:00", datetime(2024, 1, 2, 1, 4, 5)),
        ("2024-01-02", datetime(2024, 1, 2)),
        ("2024-13-02T03:04:05Z", None),
        ("never", None),
        ("", None),
    ],
)
def test_iso_timestamp(spark, text, expected):
    assert cast(spark, lambda c: iso_timestamp(c).cast("timestamp_ntz"), text) == expected


@pytest.mark.parametrize(
    "text, expected",
    [
        (None, None),
        ("2024-01-02 03:04:05", datetime(2024, 1, 2, 3, 4, 5)),
        ("1950-01-02 03:04:05", datetime(1950, 1, 2, 3, 4, 5)),
        ("2024-01-02", None),
        ("2024-01-02T03:04:05", None),
        ("2024-01-02 03:04:05.5", None),
        ("2024-13-02 03:04:05", None),
        ("02-01-2024 03:04:05", None),
        ("nan", None),
        ("", None),
    ],
)
def test_guarded_timestamp(spark, text, expected):
    assert cast(spark, lambda c: guarded_timestamp(c).cast("timestamp_ntz"), text) == expected


def test_parse_timestamps_names_missing_columns(spark):
    df = spark.createDataFrame([("2024-01-02 03:04:05", "x")], "a string, b string")
    assert parse_timestamps(df, ["a"]).dtypes == [("a", "timestamp"), ("b", "string")]
    with pytest.raises(ValueError, match="c"):
        parse_timestamps(df, ["a", "c"])


def test_project_ignores_case_and_keeps_the_names_asked_for(spark):
    df = spark.createDataFrame([(1, 2, 3)], "A int, b int, c int")
    assert project(df, ["B", "a"]).columns == ["B", "a"]
    assert drop_payload(df, "A", "absent").columns == ["b", "c"]


def test_default_column(spark):
    df = spark.createDataFrame([(1,)], "Updated_On int")
    assert default_column(df, "updated_on", F.lit(2)).first().asDict() == {"Updated_On": 1}
    assert default_column(df, "other", F.lit(2)).first().asDict() == {"Updated_On": 1, "other": 2}


def test_stamps(spark):
    moment = datetime(2024, 2, 1, 1, 30, tzinfo=timezone(timedelta(hours=2)))
    df = partition_stamp(ingest_stamp(spark.range(2), moment), date(2024, 2, 1))
    row = df.withColumn("Updated_On", F.col("Updated_On").cast("timestamp_ntz")).first()
    assert (row.Updated_On, row.DT_PARTITION) == (datetime(2024, 1, 31, 23, 30), "2024-02-01")


def test_rename_from_a_file(spark, tmp_path):
    (tmp_path / "names.json").write_text('{\n  "teamid": "team",\n  "code": "course.code"\n}')
    mapping = load_rename_map(spark, str(tmp_path / "names.json"))
    df = rename_columns(spark.createDataFrame([(1, 2, 3)], "teamid int, code int, x int"), mapping)
    assert df.columns == ["team", "course.code", "x"]
    assert stringify_all(df).first().asDict() == {"team": "1", "course.code": "2", "x": "3"}


def test_stringify_keeps_null(spark):
    df = stringify_all(spark.sql("SELECT CAST(NULL AS int) a, DATE '2024-01-02' b, true c"))
    assert tuple(df.first()) == (None, "2024-01-02", "true")
