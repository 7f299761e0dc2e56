"""Loads that must not lose rows or depend on the order of arrival."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from lakezones.functions.casts import numeric_key
from lakezones.functions.payload import TextField, extract_fields
from lakezones.operators.dedup import deduplicate_latest
from lakezones.operators.filters import latest_day, since
from lakezones.operators.keys import surrogate_key
from lakezones.operators.merge import MergeCardinalityError, merge_frames
from lakezones.plans.backfill import backfill_orders, load_backfill, load_backfills
from lakezones.plans.raw_customers import load_raw_customers, raw_records
from lakezones.sinks.tables import create_table, merge_or_create, overwrite_or_create
from lakezones.sources.pages import IncompleteLanding, page_completeness, require_complete
from lakezones.sources.tables import read_table, register_dataset
from lakezones.specs import TableSpec
from lakezones.streaming.upserts import upsert_new_files
from lakezones.streaming.watermark import WatermarkStore


@pytest.mark.parametrize("max_files", [None, 1])
@pytest.mark.parametrize("newest_first", [True, False])
def test_order_of_arrival_does_not_matter(spark, database, tmp_path, rows, max_files, newest_first):
    landing, table = str(tmp_path / "landing"), (database, "t")
    batches = [[(1, "2024-01-05", "new"), (3, None, "no time")], [(1, "2024-01-01", "old"), (2, "2024-01-02", "b")]]
    for batch in batches if newest_first else batches[::-1]:
        spark.createDataFrame(batch, "id int, at string, v string").coalesce(1).write.mode("append").parquet(landing)
        upsert_new_files(spark, landing, "id int, at string, v string", lambda r: r, table, ["id"], "at",
                         str(tmp_path / "checkpoint"), ["v"], "parquet", max_files).awaitTermination()
    assert rows(read_table(spark, table)) == [(1, "2024-01-05", "new"), (2, "2024-01-02", "b"), (3, None, "no time")]


def test_records_without_a_time_of_change_stay(spark):
    customer = '{"id":%d,"createdAt":"2024-01-01T00:00:00Z"%s}'
    records = [customer % (1, ',"updatedAt":"2024-01-02T00:00:00Z"'), customer % (2, ""), customer % (3, ',"updatedAt":"?"')]
    doc = '{"_embedded":{"customers":[%s]},"page":{"number":1,"size":9,"totalElements":3,"totalPages":1}}' % ",".join(records)
    pages = spark.createDataFrame([(doc,)], "doc string")
    now = datetime(2024, 2, 1)
    assert raw_records(pages, now).count() == 3
    assert raw_records(pages, now, "1970-01-01T00:00:00Z").count() == 3
    assert raw_records(pages, now, "2025-01-01T00:00:00Z").count() == 2


def test_text_times_are_compared_as_times(spark, rows):
    texts = ["2024-01-30", "2024-01-30T00:00:00Z", "2024-01-30 23:59:59.5", "2024-01-29T23:59:59Z", "2024-01-2", "x", None]
    frame = spark.createDataFrame([(t,) for t in texts], "at string")
    assert rows(latest_day(frame, "at")) == [("2024-01-30",), ("2024-01-30 23:59:59.5",), ("2024-01-30T00:00:00Z",)]
    late = spark.createDataFrame([("2024-01-01T00:00:00.500Z",), ("2023-12-31T23:59:59.9Z",)], "at string")
    assert rows(since(late, "at", "2024-01-01T00:00:00Z")) == [("2024-01-01T00:00:00.500Z",)]


def test_a_managed_table_is_not_dropped(spark, database, tmp_path):
    path = str(tmp_path / "data")
    spark.range(5).write.parquet(path)
    spark.sql(f"CREATE TABLE {database}.managed USING parquet AS SELECT id FROM range(5)")
    with pytest.raises(ValueError, match="managed"):
        register_dataset(spark, (database, "managed"), path)
    assert spark.table(f"{database}.managed").count() == 5
    for _ in range(2):
        assert register_dataset(spark, (database, "external"), path).count() == 5


def test_keys_equal_after_the_cast_are_one_key(spark, database):
    table = (database, "t")
    create_table(spark.createDataFrame([(1, "a")], "id bigint, v string"), table)
    batch = spark.createDataFrame([("1", "b"), ("01", "c")], "id string, v string")
    for staged in (True, False):
        with pytest.raises(MergeCardinalityError):
            merge_or_create(batch, table, ["id"], staged=staged)


@pytest.mark.parametrize("mode", ["dynamic", "static"])
def test_overwrite_replaces_all_partitions(spark, database, rows, mode):
    table = (database, "t")
    create_table(spark.createDataFrame([(1, "a"), (2, "b")], "id int, p string"), table, partition_column="p")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        overwrite_or_create(spark.createDataFrame([(3, "b")], "id int, p string"), table)
        assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    finally:
        spark.conf.unset("spark.sql.sources.partitionOverwriteMode")
    assert rows(spark.table(".".join(table))) == [(3, "b")]


def test_small_ones(spark, rows):
    keys = spark.createDataFrame([("1.0000000000000000001",), ("1.000",), ("-.5",), ("1e3",)], "k string")
    assert [row[0] for row in keys.select(numeric_key(F.col("k"))).collect()] == [None, 1, None, 1000]
    frame = spark.createDataFrame([(1, '{"t":"%s"}' % ("x" * 5000))], "`a.b` int, content string")
    (row,) = extract_fields(frame, [TextField("t", ("t",), None)]).collect()
    assert row["a.b"] == 1 and len(row["t"]) == 5000


def test_a_partition_value_gets_few_files(spark, database):
    table = (database, "t")
    rows = spark.range(0, 20_000, 1, 16).selectExpr("id", "id % 20 AS p")
    create_table(rows, table, partition_column="p")
    assert len(spark.table(".".join(table)).inputFiles()) == 20
    merge_or_create(rows.filter("id < 10000"), table, ["id", "p"], partition_column="p")
    found = read_table(spark, table)
    assert len(found.inputFiles()) == 20 and found.count() == 20_000


def test_scratch_names_may_be_column_names(spark, rows):
    names = "_matches int, _piece int, _copy int, _rows int"
    old, new = [(1, 1, 1, 1), (1, 1, 2, 2), (2, 2, 2, 2)], [(1, 7, 7, 7), (3, 8, 8, 8)]
    merged = merge_frames(spark.createDataFrame(old, names), spark.createDataFrame(new, names), ["_matches"])
    assert rows(merged) == [(1, 7, 7, 7), (1, 7, 7, 7), (2, 2, 2, 2), (3, 8, 8, 8)]
    tops = spark.createDataFrame([(1, 1, 1), (1, 2, 5)], "_key0 int, _top int, _rank int")
    for method in ("row_number", "dense_rank"):
        assert rows(deduplicate_latest(tops, "_key0", "_top", method)) == [(1, 2, 5)]
    placed = spark.createDataFrame([(5, 1, 1), (4, 2, 2)], "_place int, _offset int, _partition int")
    assert rows(surrogate_key(placed, ["_place"], "key"), "_place", "key") == [(4, 1), (5, 2)]


def test_known_dataset_keeps_its_entry(spark, database, tmp_path, rows):
    path, table = str(tmp_path / "data"), (database, "t")

    def created():
        found = spark.sql(f"DESCRIBE TABLE EXTENDED {database}.t").collect()
        return next(row["data_type"] for row in found if row["col_name"] == "Location"), spark.sql(
            f"SHOW TBLPROPERTIES {database}.t"
        ).filter("key = 'mark'").count()

    spark.range(2).write.parquet(f"{path}/day=2024-01-01")
    register_dataset(spark, table, path, ("day",))
    spark.sql(f"ALTER TABLE {database}.t SET TBLPROPERTIES ('mark' = '1')")
    before = created()
    (tmp_path / "data" / "day=2024-01-01").rename(tmp_path / "gone")
    spark.range(5, 6).selectExpr("id", "'n' AS extra").write.parquet(f"{path}/day=2024-01-02")
    assert rows(register_dataset(spark, table, path, ("day",)), "id", "extra") == [(5, "n")]
    assert created() == before and before[1] == 1
    spark.range(1).selectExpr("'a' AS id", "'n' AS extra").write.mode("overwrite").parquet(f"{path}/day=2024-01-02")
    assert rows(register_dataset(spark, table, path, ("day",)), "id") == [("a",)]
    assert created()[1] == 0


def test_several_backfills_each_from_its_own_sources(spark, database, tmp_path, rows):
    for name in ("a", "b"):
        (tmp_path / f"{name}.csv").write_text(f"id,at\n{name},2024-01-01 08:00:00\n")
    specs = [
        TableSpec("first", (), ("at",), (str(tmp_path / "a.csv"),)),
        TableSpec("lost", (), (), (str(tmp_path / "absent.csv"),)),
        TableSpec("second", (), (), (str(tmp_path / "b.csv"),)),
    ]
    with pytest.raises(ExceptionGroup, match="1 tables failed"):
        load_backfills(spark, specs, database, date(2024, 2, 1))
    first, second = (read_table(spark, (database, name)) for name in ("first", "second"))
    assert first.schema["at"].dataType.typeName() == "timestamp" and second.schema["at"].dataType.typeName() == "string"
    assert rows(first, "id") == [("a",)] and rows(second, "id") == [("b",)]


def test_backfill_of_single_lines_splits_a_file(spark, database, tmp_path):
    path = str(tmp_path / "one.csv")
    (tmp_path / "one.csv").write_text("id,v\n" + "".join(f"{i},{'x' * 20}\n" for i in range(20_000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        split = backfill_orders(spark, [path], date(2024, 2, 1), [], multi_line=False)
        whole = backfill_orders(spark, [path], date(2024, 2, 1), [])
        tasks = [frame._jdf.queryExecution().toRdd().getNumPartitions() for frame in (split, whole)]
        assert tasks[0] > 4 and tasks[1] == 1
        assert load_backfill(split, (database, "t")) and read_table(spark, (database, "t")).count() == 20_000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_incomplete_landing(spark):
    doc = '{"_embedded":{"customers":[{"id":1}]},"page":{"number":1,"size":1,"totalElements":%d,"totalPages":%d}}'
    report = lambda *totals: page_completeness(spark.createDataFrame([(doc % totals,)], "doc string")).first()
    require_complete(report(1, 1))
    for totals in ((2, 2), (2, 1), (0, 0)):
        with pytest.raises(IncompleteLanding):
            require_complete(report(*totals))


def test_merge_reads_each_side_few_times(spark, tmp_path):
    for name in ("t", "s"):
        spark.range(1000).selectExpr("id AS k", "id AS v").write.parquet(str(tmp_path / name))
    target, batch = (spark.read.parquet(str(tmp_path / name)) for name in ("t", "s"))
    plan = merge_frames(target, batch, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    # The target in full and for its keys; the batch for its keys, its rows and the rows without a key.
    assert plan.count("Relation") == 5


def test_a_record_without_time_replaces_no_later_one(spark, database, tmp_path, rows):
    customer = '{"id":%d,"createdAt":"2024-01-01T00:00:00Z"%s}'
    timed = customer % (1, ',"updatedAt":"2024-01-02T00:00:00Z"')
    records = [timed, customer % (1, ""), customer % (2, ',"updatedAt":"2024-01-09T00:00:00Z"')]
    doc = '{"_embedded":{"customers":[%s]}}' % ",".join(records)
    pages, state = spark.createDataFrame([(doc,)], "doc string"), WatermarkStore(spark, str(tmp_path / "state"))
    for _ in range(2):
        load_raw_customers(pages, (database, "t"), state, datetime(2024, 2, 1))
        assert rows(read_table(spark, (database, "t")), "customer_key", "customer_id", "updated") == [
            (1, 1, "2024-01-02T00:00:00Z"), (2, 2, "2024-01-09T00:00:00Z"),
        ]
