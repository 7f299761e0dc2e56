from datetime import date, datetime

from lakezones.operators.filters import day_range, epoch_floor, latest_day, reject_null_keys, since
from lakezones.operators.measures import (
    LoadReport,
    count_delta,
    max_watermark,
    min_rows_check,
    null_key_count,
    row_count,
)


def times(spark, *values, column="t", kind="timestamp"):
    df = spark.createDataFrame([(v,) for v in values], f"{column} string")
    return df.withColumn(column, df[column].cast(kind))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_since_keeps_the_bound_itself(spark):
    for kind in ("timestamp", "timestamp_ntz", "string"):
        suffix = "Z" if kind == "string" else ""
        df = times(spark, *[t + suffix for t in ("2024-01-01T00:00:00", "2024-01-02T00:00:00", "2024-01-03T00:00:00")], kind=kind)
        assert since(df, "t", "2024-01-02T00:00:00Z").count() == 2
        assert since(df, "t", None).count() == 3


def test_epoch_floor_drops_null_and_earlier(spark):
    df = times(spark, None, "1969-12-31T23:59:59", "1970-01-01T00:00:00", "2024-01-01", column="created")
    assert epoch_floor(df).count() == 2


def test_null_keys(spark, rows):
    df = spark.createDataFrame([(1, None), (None, 2), (3, 4), (None, None)], "a int, b int")
    assert rows(reject_null_keys(df, ["a"])) == [(1, None), (3, 4)]
    assert rows(reject_null_keys(df, ["a", "b"])) == [(3, 4)]
    assert tuple(null_key_count(df, ["a", "b"]).first()) == (4, 3)
    assert tuple(null_key_count(df.filter("false"), ["a"]).first()) == (0, 0)


def test_latest_day(spark):
    for kind in ("timestamp", "timestamp_ntz", "date"):
        df = times(spark, "2024-01-01 23:59:59", "2024-01-02 00:00:00", "2024-01-02 12:00:00", None, kind=kind)
        assert latest_day(df, "t").count() == 2
        assert latest_day(df.filter("t IS NULL"), "t").count() == 0
        assert latest_day(df.filter("false"), "t").count() == 0


def test_day_range_includes_both_days(spark):
    df = times(spark, "2024-01-01", "2024-01-02", "2024-01-03 23:59:59", "2024-01-04", None)
    assert day_range(df, "t", date(2024, 1, 2), date(2024, 1, 3)).count() == 2
    assert day_range(df, "t", date(2024, 1, 3), date(2024, 1, 2)).count() == 0


def test_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    times(spark, "2024-01-01", "2024-01-02").selectExpr("t", "t AS created", "1 AS k", "2 AS v").write.parquet(path)
    df = spark.read.parquet(path)
    assert "GreaterThanOrEqual(t," in plan(since(df, "t", "2024-01-02T00:00:00Z"))
    assert "GreaterThanOrEqual(created," in plan(epoch_floor(df))
    assert "GreaterThanOrEqual(t,ScalarSubquery" in plan(latest_day(df, "t"))
    assert "LessThan(t," in plan(day_range(df, "t", date(2024, 1, 1), date(2024, 1, 1)))
    assert "IsNotNull(k)" in plan(reject_null_keys(df, ["k"]))
    assert "ReadSchema: struct<>" in plan(row_count(df))


def test_watermark(spark):
    df = times(spark, "2024-01-01T00:00:00.9", None, "2023-12-31T00:00:00", column="updated")
    assert max_watermark(df).first()[0] == "2024-01-01T00:00:00Z"
    assert max_watermark(df.filter("updated IS NULL")).first()[0] is None
    text = spark.createDataFrame([("2024-01-01T01:00:00+01:00",)], "updated string")
    assert max_watermark(text).first()[0] == "2024-01-01T00:00:00Z"


def test_count_delta(spark):
    some, more = spark.range(2), spark.range(5)
    assert tuple(count_delta(some, more).first()) == (2, 5, 3, "inserted")
    assert tuple(count_delta(more, some).first()) == (5, 2, 3, "deleted")
    assert tuple(count_delta(some, some).first()) == (2, 2, 0, "unchanged")


def test_min_rows(spark):
    assert tuple(min_rows_check(spark.range(100)).first()) == (100, True)
    assert tuple(min_rows_check(spark.range(99)).first()) == (99, False)
    assert tuple(min_rows_check(spark.range(3), 3).first()) == (3, True)


def test_report():
    assert LoadReport("t", 0, 100).status == "inserted" and LoadReport("t", 0, 100).success
    assert LoadReport("t", 5, 3).message() == "t: 2 rows were deleted; fewer than 100 rows (3)"
    assert LoadReport("t", 200, 200).message() == "t: no new rows; at least 100 rows (200)"
