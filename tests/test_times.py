"""Records replace others by the time they name, whatever form it has and whenever they arrive."""

import itertools
import json
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from lakezones.functions.casts import numeric_key
from lakezones.operators.dedup import deduplicate_latest
from lakezones.operators.measures import max_watermark
from lakezones.operators.merge import not_older
from lakezones.plans.raw_customers import load_raw_customers
from lakezones.sources.tables import read_table
from lakezones.streaming.latest import latest_by_state
from lakezones.streaming.upserts import upsert_new_files
from lakezones.streaming.watermark import WatermarkStore

RUN = datetime(2024, 5, 1, 12)
# From the earliest to the latest.
TIMES = [None, "2024-01-01T02:00:00+02:00", "2024-01-01T00:00:00.500Z", "2024-01-01T01:00:00Z", "2024-01-01T02:00:00Z"]


def page(spark, *records):
    docs = [{"id": 1, "createdAt": "2020-01-01T00:00:00Z", "firstName": name, "updatedAt": time} for name, time in records]
    return spark.createDataFrame([(json.dumps({"_embedded": {"customers": docs}}),)], "doc string")


def kept(spark, table):
    (row,) = spark.table(table).selectExpr("get_json_object(content, '$.firstName') AS name").collect()
    return row.name


@pytest.mark.parametrize("earlier, later", list(itertools.combinations(range(len(TIMES)), 2)))
def test_place_of_records(spark, earlier, later):
    rows = [(1, TIMES[earlier] or "zzz", "a"), (1, TIMES[later], "b")]
    df = spark.createDataFrame(rows, "id int, updated string, name string")
    assert deduplicate_latest(df, "id", "updated", times=["updated"]).first().name == "b"
    old, new = df.filter("name = 'a'"), df.filter("name = 'b'")
    assert not_older(old, new, ["id"], ["updated"], times=["updated"]).count() == 0
    assert not_older(new, old, ["id"], ["updated"], times=["updated"]).count() == 1


@pytest.mark.parametrize("loads", [(("a", "zzz"), ("b", TIMES[3])), (("b", TIMES[3]), ("a", "zzz"))])
def test_unreadable_time_replaces_nothing(spark, database, tmp_path, loads):
    state, table = WatermarkStore(spark, str(tmp_path / "s")), f"{database}.c"
    for load in loads:
        load_raw_customers(page(spark, load), table, state, RUN)
    assert kept(spark, table) == "b"
    load_raw_customers(page(spark, ("c", "2025-01-01T00:00:00Z")), table, state, RUN)
    assert kept(spark, table) == "c"


@pytest.mark.parametrize("order", list(itertools.permutations(["x", "z", "y"]))[:4])
def test_ties_do_not_depend_on_arrival(spark, database, tmp_path, order):
    state, table = WatermarkStore(spark, str(tmp_path / "s")), f"{database}.c"
    for name in order:
        load_raw_customers(page(spark, (name, TIMES[3])), table, state, RUN)
    load_raw_customers(page(spark, ("a", TIMES[1]), ("b", TIMES[3])), table, state, RUN)
    assert kept(spark, table) == "z"


def test_numbers_go_on_after_records_that_lose(spark, database, tmp_path):
    state, table = WatermarkStore(spark, str(tmp_path / "s")), f"{database}.c"

    def load(*records):
        docs = [{"id": i, "createdAt": "2020-01-01T00:00:00Z", "updatedAt": t, "firstName": n} for i, t, n in records]
        df = spark.createDataFrame([(json.dumps({"_embedded": {"customers": docs}}),)], "doc string")
        load_raw_customers(df, table, state, RUN, full=True)
        return sorted(
            map(tuple, spark.table(table).selectExpr("customer_key", "customer_id", "get_json_object(content, '$.firstName')").collect())
        )

    assert load((5, TIMES[3], "e"), (7, TIMES[3], "g")) == [(1, 5, "e"), (2, 7, "g")]
    # A record that is older, one that is newer, and a new customer.
    assert load((5, TIMES[1], "old"), (7, TIMES[4], "new"), (6, "?", "f")) == [(1, 5, "e"), (2, 7, "new"), (3, 6, "f")]


def test_stream_of_files(spark, database, tmp_path):
    table, landing = f"{database}.c", str(tmp_path / "landing")
    for number, (name, time) in enumerate([("b", TIMES[2]), ("a", TIMES[1]), ("x", "zzz")]):
        rows = spark.createDataFrame([(1, time, name)], "id int, updated string, name string")
        rows.coalesce(1).write.mode("append").parquet(landing)
        upsert_new_files(
            spark, landing, "id int, updated string, name string", lambda rows: rows, table, ["id"], "updated",
            str(tmp_path / "checkpoint"), file_format="parquet", times=["updated"],
        ).awaitTermination()
        assert read_table(spark, table).first().name == "b"


@pytest.fixture
def landed(spark, database, tmp_path):
    """Land rows, run the stream, and give its report and the table."""
    state, landing = WatermarkStore(spark, str(tmp_path / "state")), str(tmp_path / "landing")
    schema = "id bigint, updated string, name string"

    def run(*rows, checkpoint="checkpoint", max_files=None):
        if rows:
            spark.createDataFrame(rows, schema).repartition(2).write.mode("append").parquet(landing)
        report = latest_by_state(
            spark, landing, schema, lambda df: df, f"{database}.t", ["id"], "updated", str(tmp_path / checkpoint), state,
            "t", ties=["name"], delay="1 hour", file_format="parquet", max_files=max_files,
        )
        found = read_table(spark, (database, "t"))
        return report, sorted(map(tuple, found.select("id", "name").collect())), sorted(found.inputFiles())

    return run


def test_latest_by_state(spark, landed):
    report, rows, _ = landed((1, TIMES[3], "a"), (1, TIMES[3], "b"), (2, "zzz", "x"), (None, TIMES[3], "n"))
    assert rows == [(1, "b"), (2, "x")]
    assert (report.rows, report.null_keys, report.without_time, report.late) == (4, 1, 1, 0)
    assert report.watermark == TIMES[3]
    # Repeats, a late record of a known key, and one of a key that only comes late.
    report, rows, files = landed((1, TIMES[3], "b"), (1, "2023-12-01T00:00:00Z", "z"), (3, "2023-01-01T00:00:00Z", "late"))
    assert rows == [(1, "b"), (2, "x"), (3, "late")] and report.late == 2
    # Nothing has landed, or only what was there before: the table is not written.
    report, rows, same = landed()
    assert same == files and report.rows == 0
    report, rows, same = landed((1, TIMES[3], "b"), (2, "yyy", "a"))
    assert same == files and report.rows == 2
    report, rows, _ = landed((2, "2020-01-01T00:00:00Z", "read"))
    assert rows == [(1, "b"), (2, "read"), (3, "late")]


def test_state_that_is_lost_changes_nothing(spark, landed):
    _, rows, files = landed((1, TIMES[4], "new"), (2, TIMES[1], "x"))
    _, again, _ = landed((1, TIMES[1], "old"), checkpoint="another", max_files=1)
    assert again == rows == [(1, "new"), (2, "x")]


def test_a_failed_merge_is_repeated(spark, landed, monkeypatch):
    from lakezones.streaming import latest

    landed((1, TIMES[1], "a"))
    merge = latest.merge_or_create

    def fail(*args, **kwargs):
        merge(*args, **kwargs)
        raise RuntimeError("lost after the merge")

    monkeypatch.setattr(latest, "merge_or_create", fail)
    with pytest.raises(Exception, match="lost after the merge"):
        landed((1, TIMES[4], "b"), (2, TIMES[4], "c"))
    monkeypatch.setattr(latest, "merge_or_create", merge)
    report, rows, _ = landed()
    assert rows == [(1, "b"), (2, "c")] and report.rows == 2


def test_hot_key_is_reduced_before_the_shuffle(spark, landed, tmp_path):
    rows = [(1 if i % 3 else i, f"2024-01-01T{i % 24:02}:00:00Z", f"n{i}") for i in range(300)]
    _, found, _ = landed(*rows)
    assert (1, max(name for i, time, name in rows if i == 1 and "T23" in time)) in found


def test_watermark_of_text_with_bad_times(spark):
    df = spark.createDataFrame([("zzz",), (None,), (TIMES[2],), (TIMES[1],)], "updated string")
    assert max_watermark(df).first()[0] == "2024-01-01T00:00:00Z"
    assert max_watermark(df.filter("updated = 'zzz'")).first()[0] is None


@pytest.mark.parametrize(
    "text, expected",
    [
        ("1.0000000000000000001e0", None), ("1.0000000000000000001e19", None), ("1.5e1", 15), ("15e-1", None), ("1500e-2", 15),
        ("0.00001e5", 1), ("123456789012345678e1", 1234567890123456780), ("9223372036854775807.0", 9223372036854775807),
        ("9223372036854775808.0", None), ("-9223372036854775808.000", -9223372036854775808), ("-1.20e1", -12), ("0e999999999999", 0),
        ("1e-999999999999", None), ("1e999999999999", None), (".5e1", 5), ("5.", 5), (".", None), ("e5", None), ("+.e1", None),
        ("000.000", 0), ("  7.0 ", 7), ("00012.0", 12), ("1e+3", 1000), ("1.e2", 100), ("-0.0", 0), ("1_000", None), ("100e-2", 1),
        ("0.10e1", 1), ("0.010e1", None), ("1e18", 10**18), ("1e19", None),
    ],
)
def test_exact_keys(spark, text, expected):
    assert spark.createDataFrame([(text,)], "k string").select(numeric_key(F.col("k"))).first()[0] == expected
