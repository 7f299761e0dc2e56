from pyspark.sql import functions as F

from lakezones.operators import keys
from lakezones.operators.keys import next_key, surrogate_key
from lakezones.session import stage


def test_numbers_follow_the_order_without_gaps(spark):
    df = spark.range(0, 1000, 1, 7).select(((F.col("id") * 37) % 1000).alias("v"))
    keyed = surrogate_key(df, ["v"], "k", start_key=5).collect()
    assert sorted((r.v, r.k) for r in keyed) == [(v, v + 5) for v in range(1000)]


def test_hot_first_column_is_spread_by_the_others(spark):
    df = spark.range(0, 20000, 1, 8).select(F.lit("same").alias("day"), F.col("id"))
    keyed = surrogate_key(df, ["day", "id"], "k")
    assert keyed.filter("k <> id + 1").count() == 0
    stored = keyed._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" in stored and "id#" in stored


def test_rows_equal_in_the_order_are_spread(spark, monkeypatch):
    staged = []
    monkeypatch.setattr(keys, "stage", lambda df, label: staged.append(stage(df, label)) or staged[-1])
    df = spark.range(0, 20000, 1, 8).select(F.lit(1).alias("day"), F.col("id"), F.create_map(F.lit("a"), "id").alias("m"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        keyed = surrogate_key(df, ["day"], "k")
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(r.k for r in keyed.select("k").collect()) == list(range(1, 20001))
    shares = [r["count"] for r in staged[0].groupBy(F.shiftright("_place", 33)).count().collect()]
    assert len(shares) == 8 and max(shares) < 5000


def test_nulls_first_and_empty(spark):
    df = spark.createDataFrame([(2,), (None,), (1,)], "v int")
    assert sorted(((r.v or 0), r.k) for r in surrogate_key(df, ["v"], "k").collect()) == [(0, 1), (1, 2), (2, 3)]
    assert surrogate_key(df.filter("false"), ["v"], "k").count() == 0


def test_next_key(spark):
    df = spark.createDataFrame([(3,), (9,)], "customer_key long")
    assert next_key(df) == 10
    assert next_key(df.filter("false")) == 1


def test_only_the_offsets_are_broadcast_and_windowed(spark):
    plan = surrogate_key(spark.range(100), ["id"], "k")._jdf.queryExecution().executedPlan().toString()
    window = plan[plan.index("Window [") :]
    assert "HashAggregate" in window  # the window runs over one row per partition
    assert "SortMergeJoin" not in plan
