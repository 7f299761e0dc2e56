"""Rows in irregular windows, and loads of several tables at once."""

import random
import threading
import time
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from lakezones.operators.intervals import bin_width, join_windows
from lakezones.plans.runner import TableTimeout, run_tables
from lakezones.specs import TableSpec

START = datetime(2024, 1, 1)


@pytest.mark.parametrize("bin_seconds", [None, 1, 3600, 10**9])
def test_against_all_pairs(spark, bin_seconds):
    rnd = random.Random(1)
    points = [(i, START + timedelta(minutes=rnd.randint(-100, 5000)) if rnd.random() < 0.95 else None) for i in range(200)]
    windows = []
    for i in range(60):
        first = START + timedelta(minutes=rnd.randint(0, 4000))
        length = timedelta(minutes=rnd.choice([0, 1, 10, 200, -5]))
        windows.append((i, first if rnd.random() < 0.9 else None, first + length if rnd.random() < 0.9 else None))
    # Long windows are left out where bins are a second long.
    windows += [(100, START, START + timedelta(days=400 if bin_seconds != 1 else 1)), (101, points[0][1], points[0][1])]
    found = join_windows(
        spark.createDataFrame(points, "id int, at timestamp"), "at", spark.createDataFrame(windows, "w int, a timestamp, b timestamp"),
        "a", "b", bin_seconds,
    )
    assert found.columns == ["id", "at", "w", "a", "b"]
    expected = sorted((i, w) for i, at in points if at for w, a, b in windows if a and b and a <= at <= b)
    assert sorted((row.id, row.w) for row in found.collect()) == expected and len(expected) > 100


def test_days_last_until_midnight(spark):
    points = [(1, datetime(2024, 1, 2, 23, 59, 59, 999999)), (2, datetime(2024, 1, 3)), (3, datetime(2024, 1, 1)), (4, datetime(2023, 12, 31, 23))]
    rows = spark.createDataFrame(points, "id int, at timestamp")
    windows = spark.createDataFrame([(date(2024, 1, 1), date(2024, 1, 2)), (date(2024, 1, 5), date(2024, 1, 4))], "a date, b date")
    assert sorted(row.id for row in join_windows(rows, "at", windows, "a", "b").collect()) == [1, 3]
    days = rows.withColumn("at", F.col("at").cast("date"))
    assert sorted(row.id for row in join_windows(days, "at", windows, "a", "b").collect()) == [1, 3]
    ntz = rows.withColumn("at", F.col("at").cast("timestamp_ntz"))
    assert sorted(row.id for row in join_windows(ntz, "at", windows, "a", "b").collect()) == [1, 3]


def test_no_window_and_clashing_names(spark):
    rows = spark.range(3).select("id", F.lit(START).alias("_bin"))
    none = spark.createDataFrame([], "a date, b date")
    assert join_windows(rows, "_bin", none, "a", "b").count() == 0
    with pytest.raises(ValueError, match="share columns"):
        join_windows(rows, "_bin", none.withColumnRenamed("a", "ID"), "ID", "b")


def test_no_comparison_of_all_rows(spark):
    rows = spark.range(1000).select("id", (F.lit(START) + F.make_dt_interval(hours=F.col("id").cast("int"))).alias("at"))
    windows = rows.select(F.col("id").alias("w"), F.col("at").alias("a"), (F.col("at") + F.expr("INTERVAL 1 DAY")).alias("b"))
    plan = join_windows(rows, "at", windows, "a", "b")._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and ("HashJoin" in plan or "SortMergeJoin" in plan)


def test_rows_meet_windows_in_blocks(spark):
    """Columns of windows come in runs, and a block of rows follows itself, so that files of the result are small."""
    rows = spark.range(0, 1000, 1, 2).select("id", (F.lit(START) + F.make_dt_interval(days=(F.col("id") % 4).cast("int"))).alias("at"))
    windows = spark.range(60).selectExpr("id AS w", "DATE '2023-12-31' + int(id % 5) AS a", "DATE '2024-01-01' + int(id % 5) AS b")
    found = [(row.id, row.w) for row in join_windows(rows, "at", windows, "a", "b").collect()]
    expected = [(i, w) for i in range(1000) for w in range(60) if w % 5 - 1 <= i % 4 <= w % 5]
    assert sorted(found) == sorted(expected) and len(found) == 24_000
    changes = sum(a[1] != b[1] for a, b in zip(found, found[1:], strict=False))
    assert changes < len(found) / 20


@pytest.mark.parametrize("block_rows", [1, 7, 128])
def test_blocks_keep_equal_rows_nulls_and_any_type(spark, block_rows):
    text = "TIMESTAMP '2024-01-01 10:00:00' + make_dt_interval(id % 3)"
    rows = spark.range(400).selectExpr(
        "id % 2 AS `a.b`", f"CASE WHEN id % 10 < 9 THEN {text} END AS at", "CASE WHEN id % 5 > 0 THEN map('k', id % 2) END AS _packed",
        "array(named_struct('m', map(id % 2, 1))) AS n", "parse_json(string(id % 2)) AS v", "make_interval(0, int(id % 2)) AS i",
        "CAST(NULL AS string) AS _block", "double('nan') AS _least",
    )
    windows = spark.createDataFrame([(1, date(2024, 1, 1), date(2024, 1, 2)), (1, date(2024, 1, 1), date(2024, 1, 2)), (2, None, date(2024, 1, 3))], "`w.x` int, a date, b date")
    found = join_windows(rows, "at", windows, "a", "b", block_rows=block_rows)
    assert found.columns == [*rows.columns, *windows.columns]
    assert [field.dataType for field in found.schema] == [field.dataType for field in (*rows.schema, *windows.schema)]
    every = [F.col(f"`{name}`").cast("string") for name in rows.columns]
    inside = rows.filter("CAST(at AS date) < DATE '2024-01-03'").select(*every)
    expected = sorted(map(str, inside.unionAll(inside).collect()))
    assert sorted(map(str, found.select(*every).collect())) == expected and len(expected) == 480


def test_long_windows_have_a_bounded_number_of_bins(spark):
    bounds = spark.createDataFrame([(0, 10**6)] * 100 + [(0, 10**6 * 10**8)], "f bigint, p bigint")
    width = bin_width(bounds, "f", "p")
    assert 10**8 / width <= 10_000
    assert bin_width(bounds.filter("false"), "f", "p") == 1


# -- Runs ----------------------------------------------------------------------------------------

SPECS = [TableSpec(name) for name in "abcde"]


def test_at_most_two_at_once(spark):
    running, most, lock = set(), [], threading.Lock()

    def load(spec):
        with lock:
            running.add(spec.name)
            most.append(len(running))
        found = spark.range(10).count(), spark.sparkContext.getLocalProperty("spark.scheduler.pool")
        time.sleep(0.3)
        with lock:
            running.discard(spec.name)
        return found

    results = run_tables(SPECS, load, at_most=2)
    assert list(results) == list("abcde") and max(most) == 2
    assert {count for count, _ in results.values()} == {10}
    assert {pool for _, pool in results.values()} == {"table-0", "table-1"}
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


def test_tables_at_once_keep_their_own_tag_and_pool(spark):
    both = threading.Barrier(2, timeout=60)

    def load(spec):
        both.wait()
        found = spark.sparkContext.getLocalProperty("spark.scheduler.pool"), [tag.split("-")[1] for tag in spark.sparkContext.getJobTags()]
        both.wait()
        return found

    assert run_tables(SPECS[:2], load, at_most=2) == {"a": ("table-0", ["a"]), "b": ("table-1", ["b"])}


@pytest.mark.parametrize("at_most", [1, 3])
def test_retries_wait_longer_each_time(spark, at_most):
    tries, waits = {}, []

    def load(spec):
        tries.setdefault(spec.name, []).append(time.monotonic())
        if spec.name == "b" and len(tries["b"]) < 3:
            raise OSError("no answer")
        if spec.name == "d":
            raise ValueError("bad table")
        return spec.name

    with pytest.raises(ExceptionGroup) as failed:
        run_tables(SPECS, load, at_most=at_most, retries=2, first_wait=0.1)
    (error,) = failed.value.exceptions
    assert isinstance(error, ValueError) and error.__notes__ == ["while loading table d"]
    assert {name: len(at) for name, at in tries.items()} == {"a": 1, "b": 3, "c": 1, "d": 3, "e": 1}
    waits = [later - earlier for earlier, later in zip(tries["b"], tries["b"][1:])]
    assert waits[0] >= 0.1 and waits[1] >= 0.2


@pytest.mark.parametrize("at_most", [1, 2])
def test_a_slow_table_is_cancelled_alone(spark, at_most):
    slept = F.reflect(F.lit("java.lang.Thread"), F.lit("sleep"), F.lit(200).cast("bigint"))

    def load(spec):
        if spec.name == "b":
            spark.range(0, 500, 1, 1).select(slept).write.format("noop").mode("overwrite").save()
        return spark.range(100).count()

    start = time.monotonic()
    with pytest.raises(ExceptionGroup) as failed:
        run_tables(SPECS[:3], load, at_most=at_most, retries=2, timeout=6)
    assert [type(error) for error in failed.value.exceptions] == [TableTimeout]
    assert time.monotonic() - start < 60


def test_nothing_to_load(spark):
    assert run_tables([], lambda spec: 1, at_most=2) == {}
