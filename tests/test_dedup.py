from datetime import date

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakezones.operators.dedup import deduplicate_latest, duplicate_keys

ROWS = [
    (1, date(2024, 1, 1), "a"),
    (1, date(2024, 1, 3), "b"),
    (1, date(2024, 1, 3), "c"),
    (1, None, "d"),
    (2, None, "e"),
    (2, None, "f"),
    (None, date(2024, 1, 1), "g"),
    (None, date(2024, 1, 2), "h"),
    (3, date(2024, 1, 1), "i"),
]
SCHEMA = "k int, day date, rank string"


def test_row_number_keeps_one_row_per_key(spark, rows):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert rows(deduplicate_latest(df, "k", "day", ties=["rank"]), "k", "rank") == [
        (None, "h"), (1, "c"), (2, "f"), (3, "i"),
    ]
    assert deduplicate_latest(df, "k", "day").count() == 4
    assert deduplicate_latest(df, "k", "day").columns == df.columns


def test_dense_rank_keeps_all_latest_rows(spark, rows):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert rows(deduplicate_latest(df, "k", "day", "dense_rank"), "k", "rank") == [
        (None, "h"), (1, "b"), (1, "c"), (2, "e"), (2, "f"), (3, "i"),
    ]


def test_wrong_arguments(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    for arguments in (("x", "day"), ("k", "x"), ("k", "day", "rank")):
        with pytest.raises(ValueError):
            deduplicate_latest(df, *arguments)
    with pytest.raises(ValueError):
        deduplicate_latest(df, "k", "day", ties=["x"])


def test_duplicate_keys(spark, rows):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert rows(duplicate_keys(df, ["k"])) == [(None, 2), (1, 4), (2, 2)]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 3))), max_size=12))
def test_against_brute_force(spark, pairs):
    data = [(k, v, i) for i, (k, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, "k int, v int, i int")
    weight = lambda v: (v is not None, v or 0)
    top = {}
    for k, v, i in data:
        top[k] = max(top.get(k, (False, 0)), weight(v))
    latest = {(k, v, i) for k, v, i in data if weight(v) == top[k]}
    ranked = deduplicate_latest(df, "k", "v", "dense_rank")
    assert {tuple(r) for r in ranked.collect()} == latest
    first = deduplicate_latest(df, "k", "v", ties=["i"])
    kept = {tuple(r) for r in first.collect()}
    assert kept == {max((r for r in latest if r[0] == k), key=lambda r: r[2]) for k in top}
    assert {tuple(r) for r in deduplicate_latest(first, "k", "v", ties=["i"]).collect()} == kept


def test_each_task_sends_one_row_per_key(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("0 AS k", "id AS v").repartition(4).write.parquet(path)
    kept = deduplicate_latest(spark.read.parquet(path), "k", "v")
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan
    assert kept.first().v == 999


def test_hot_key_of_dense_rank_is_split(spark):
    """Two thirds of the rows are the latest of one key; the join splits them over tasks."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before = {name: spark.conf.get(name, None) for name in conf}
    try:
        for name, value in conf.items():
            spark.conf.set(name, value)
        df = spark.range(0, 60000, 1, 16).select(
            F.when(F.col("id") < 40000, 0).otherwise(F.col("id")).alias("k"), F.lit(1).alias("v"), F.col("id")
        )
        kept = deduplicate_latest(df, "k", "v", "dense_rank")
        assert kept.count() == 60000
        kept.collect()
        assert "skew=true" in kept._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
