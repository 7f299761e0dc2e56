import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakezones.operators import merge
from lakezones.operators.merge import (
    MergeCardinalityError,
    align,
    check_cardinality,
    keys_fit_broadcast,
    merge_frames,
)
from lakezones.specs import TableSpec

SCHEMA = "k int, v string"


def test_matched_unmatched_and_null_keys(spark, rows):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], SCHEMA)
    source = spark.createDataFrame([("B", 2), ("C", 3), ("N", None)], "V string, K int")
    assert rows(merge_frames(target, source, ["k"])) == [
        (None, "N"), (None, "n"), (1, "a"), (2, "B"), (3, "C"),
    ]


def test_columns_follow_the_target(spark):
    target = spark.createDataFrame([("a", 1)], "v string, k long")
    merged = merge_frames(target, spark.createDataFrame([(2, 7, 0.5)], "k int, v int, more double"), ["k"])
    assert merged.dtypes == [("v", "string"), ("k", "bigint")]
    with pytest.raises(ValueError, match="v"):
        merge_frames(target, spark.createDataFrame([(2,)], "k int"), ["k"])


def test_align_quotes_names(spark):
    df = spark.createDataFrame([(1,)], "`A.b` int")
    assert align(df, spark.createDataFrame([(1,)], "`a.B` long").schema).dtypes == [("a.B", "bigint")]


def test_cardinality(spark, rows):
    target = spark.createDataFrame([(1, "a")], SCHEMA)
    twice_new = spark.createDataFrame([(2, "x"), (2, "y"), (None, "p"), (None, "q")], SCHEMA)
    check_cardinality(target, twice_new, ["k"])
    assert rows(merge_frames(target, twice_new, ["k"])) == [(None, "p"), (None, "q"), (1, "a"), (2, "x"), (2, "y")]
    with pytest.raises(MergeCardinalityError, match="'k': 1"):
        check_cardinality(target, spark.createDataFrame([(1, "x"), (1, "y")], SCHEMA), ["k"])


def test_composite_key(spark, rows):
    target = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, None, "n")], "k int, d int, v string")
    source = spark.createDataFrame([(1, 2, "B"), (2, 2, "C"), (1, None, "N")], "k int, d int, v string")
    assert rows(merge_frames(target, source, ["k", "d"])) == [
        (1, None, "N"), (1, None, "n"), (1, 1, "a"), (1, 2, "B"), (2, 2, "C"),
    ]


def test_empty_sides(spark, rows):
    some, none = spark.createDataFrame([(1, "a")], SCHEMA), spark.createDataFrame([], SCHEMA)
    assert rows(merge_frames(some, none, ["k"])) == [(1, "a")]
    assert rows(merge_frames(none, some, ["k"])) == [(1, "a")]


def test_each_matched_target_row_is_replaced(spark, rows):
    target = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], SCHEMA)
    assert rows(merge_frames(target, spark.createDataFrame([(1, "N")], SCHEMA), ["k"])) == [(1, "N"), (1, "N"), (2, "c")]


key = st.one_of(st.none(), st.integers(0, 6))


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.tuples(key, st.integers(0, 3)), max_size=8),
    st.dictionaries(key, st.integers(4, 7), max_size=5),
    st.booleans(),
)
def test_against_brute_force(spark, old, new, broadcast):
    target = spark.createDataFrame(old, "k int, v int")
    source = spark.createDataFrame(list(new.items()), "k int, v int")
    known = {k for k, _ in old if k is not None}
    expected = [(k, new.get(k, v) if k is not None else v) for k, v in old]
    expected += [(k, v) for k, v in new.items() if k not in known]
    order = lambda r: (r[0] is not None, r[0] or 0, r[1])
    merged = merge_frames(target, source, ["k"], broadcast)
    assert sorted(map(tuple, merged.collect()), key=order) == sorted(expected, key=order)
    if None not in new:
        again = merge_frames(merged, source, ["k"], broadcast)
        assert sorted(map(tuple, again.collect()), key=order) == sorted(expected, key=order)


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_key_with_many_matches_is_written_in_pieces(spark, monkeypatch, broadcast):
    monkeypatch.setattr(merge, "COPIES_PER_PIECE", 100)
    hot = {0: 1050, 1: 100, 2: 101, 3: 99, 4: 1}
    target = spark.createDataFrame([(k, i) for k, n in hot.items() for i in range(n)], "k int, v int")
    batch = spark.createDataFrame([(k, -1) for k in (0, 1, 2, 3, 5)], "k int, v int")
    counts = merge_frames(target, batch, ["k"], broadcast).groupBy("k", "v").count()
    assert {tuple(r) for r in counts.collect()} == {
        (0, -1, 1050), (1, -1, 100), (2, -1, 101), (3, -1, 99), (4, 0, 1), (5, -1, 1),
    }


def test_the_pieces_are_written_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(merge, "COPIES_PER_PIECE", 100)
    target = spark.range(2000).select(F.lit(1).alias("k"), F.col("id").alias("v"))
    merged = merge_frames(target, spark.createDataFrame([(1, -1)], "k int, v bigint"), ["k"], True, 8)
    written = merged.groupBy(F.spark_partition_id()).count().collect()
    assert sum(row["count"] for row in written) == 2000 and max(row["count"] for row in written) <= 300


def test_small_batch_does_not_shuffle_the_target(spark, tmp_path):
    spark.range(1000).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "t"))
    spark.range(10).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / "s"))
    target, batch = spark.read.parquet(str(tmp_path / "t")), spark.read.parquet(str(tmp_path / "s"))
    merged = merge_frames(target, batch, ["k"], keys_fit_broadcast(batch, ["k"]))
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert "LeftAnti, BuildRight" in plan and "LeftSemi, BuildRight" in plan and "SortMergeJoin" not in plan
    # The full scan of the target feeds the broadcast join; all other scans of it read the keys alone.
    lines = plan.splitlines()
    scans = [i for i, line in enumerate(lines) if re.search(r"FileScan.*/t\]", line)]
    wide = [i for i in scans if "v#" in lines[i].split("Batched")[0]]
    assert len(wide) == 1 and len(scans) > 1 and "LeftAnti" in lines[wide[0] - 1] + lines[wide[0] - 2]


def test_broadcast_is_bounded_by_the_size_of_the_keys(spark, monkeypatch):
    batch = spark.createDataFrame([(1, "é"), (None, "abcd")], "k int, t string")
    assert keys_fit_broadcast(batch, ["k", "t"])
    assert keys_fit_broadcast(batch.filter("false"), ["k"])
    for limit, fits in ((71, True), (70, False)):  # two entries, 1 + 0 and 2 + 4 bytes
        monkeypatch.setattr(merge, "BROADCAST_BYTES", limit)
        assert keys_fit_broadcast(batch, ["k", "t"]) is fits


def test_hot_target_key_is_split(spark, tmp_path):
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
        # Half of the target has no key, a quarter one and the same.
        key = F.when(F.col("id") < 30000, None).when(F.col("id") < 45000, 7).otherwise(F.col("id"))
        target = spark.range(0, 60000, 1, 16).select(key.alias("k"), F.col("id").alias("v"))
        spark.range(50000, 70000).selectExpr("id AS k", "-1L AS v").write.parquet(str(tmp_path / "batch"))
        batch = spark.read.parquet(str(tmp_path / "batch"))
        merged = merge_frames(target, batch, ["k"])
        assert merged.filter("v < 0").count() == 20000
        assert len(merged.collect()) == 70000
        assert "SortMergeJoin(skew=true)" in merged._jdf.queryExecution().executedPlan().toString()
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def test_condition():
    assert TableSpec("t", ("a", "b")).condition == "old.`a` = new.`a` AND old.`b` = new.`b`"
