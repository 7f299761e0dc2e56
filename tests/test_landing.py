"""Ragged extracts, the end of a page sequence, and tables found below a location."""

import json
import random
import shutil
from datetime import date

import pytest
from pyspark.sql import types as T

from lakezones.plans.backfill import TooManyRejects, backfill_orders, load_backfill, load_backfills
from lakezones.sources.delimited import accepted_rows, read_checked_csv, rejected_rows
from lakezones.sources.discovery import IncompatibleTypes, combine_types, discover_tables
from lakezones.sources.pages import _first_missing, last_page, pages_until_end
from lakezones.sources.tables import read_table, register_dataset
from lakezones.specs import TableSpec

DAY = date(2024, 2, 1)


@pytest.fixture
def csv(tmp_path):
    def write(*lines, name="a.csv"):
        path = tmp_path / name
        path.write_text("\n".join(lines) + "\n")
        return str(path)

    return write


@pytest.mark.parametrize("multi_line", [True, False])
def test_ragged_rows(spark, csv, multi_line):
    path = csv(
        "id,name,note", "1,x,y", "2,x,y,EXTRA", "3,x", '4,"a,b",c', '5,"a,b",c,d', "6", '7,"say ""hi"", you",z', "8,,,", '9,a"b,c"d,e,f',
        "NA,nan,007",
    )
    df = read_checked_csv(spark, path, multi_line=multi_line)
    good = sorted(map(tuple, accepted_rows(df).collect()), key=str)
    assert good == sorted(
        [("1", "x", "y"), ("3", "x", None), ("4", "a,b", "c"), ("6", None, None), ("7", 'say "hi", you', "z"), (None, None, "007")], key=str
    )
    bad = {row.text: (row.expected, row.found) for row in rejected_rows(df).collect()}
    assert bad == {
        "2,x,y,EXTRA": (3, 4), '5,"a,b",c,d': (3, 4), "8,,,": (3, 4), '9,a"b,c"d,e,f': (3, None),
    }
    assert rejected_rows(df).first().source.endswith("a.csv")
    strict = read_checked_csv(spark, path, multi_line=multi_line, short_rows=False)
    assert {row.text for row in rejected_rows(strict).collect()} == {*bad, "3,x", "6"}
    # Counting or reading one column finds the same rows.
    assert accepted_rows(df).count() == 6 and rejected_rows(df).count() == 4
    assert sorted(row[0] or "" for row in accepted_rows(df).select("id").collect()) == ["", "1", "3", "4", "6", "7"]


def test_line_breaks_in_quotes(spark, csv):
    df = read_checked_csv(spark, csv("id,name", '1,"a', 'b"', '2,"c', 'd",EXTRA', "3,e"))
    assert sorted(map(tuple, accepted_rows(df).collect())) == [("1", "a\nb"), ("3", "e")]
    assert [row.text for row in rejected_rows(df).collect()] == ['2,"c\nd",EXTRA']


def test_rejects_of_a_backfill(spark, database, csv):
    paths = [csv("id,name", "1,x", "2,y,EXTRA"), csv("name,id,more", "z,3,m", "z,4,m,n,o", name="b.csv")]
    table, rejects = (database, "t"), (database, "t_rejects")
    for _ in range(2):
        orders = backfill_orders(spark, paths, DAY, (), rejects=True)
        report = load_backfill(orders, table, replace=True, rejects_table=rejects)
        assert (report.rows, report.rejected, bool(report)) == (2, 2, True)
    found = sorted(map(tuple, read_table(spark, table).select("id", "name", "more").collect()))
    assert found == [("1", "x", None), ("3", "z", "m")]
    bad = read_table(spark, rejects)
    assert sorted(map(tuple, bad.select("text", "expected", "found").collect())) == [("2,y,EXTRA", 2, 3), ("z,4,m,n,o", 3, 5)]
    assert {row.DT_PARTITION for row in bad.collect()} == {"2024-02-01"}
    # Without the column of rejects the rows are left out all the same.
    assert backfill_orders(spark, paths, DAY, ()).count() == 2


def test_too_many_rejects(spark, database, csv):
    paths = [csv("id,name", "1,x", "2,y,EXTRA", "3,y,EXTRA")]
    orders = backfill_orders(spark, paths, DAY, (), rejects=True)
    with pytest.raises(TooManyRejects):
        load_backfill(orders, (database, "t"), rejects_table=(database, "r"), most_rejects=1)
    assert read_table(spark, (database, "t")) is None and read_table(spark, (database, "r")) is None
    assert load_backfill(orders, (database, "t"), rejects_table=(database, "r"), most_rejects=2).rejected == 2


def test_only_rejects(spark, database, csv):
    orders = backfill_orders(spark, [csv("id,name", "2,y,EXTRA")], DAY, (), rejects=True)
    report = load_backfill(orders, (database, "t"), rejects_table=(database, "r"))
    assert (report.rows, report.rejected, bool(report)) == (0, 1, False)
    assert read_table(spark, (database, "t")) is None
    assert read_table(spark, (database, "r")).count() == 1


def test_rejects_of_several_tables(spark, database, csv):
    specs = [
        TableSpec("a", sources=(csv("id,day", "1,2024-01-01 00:00:00", "1,2,3"),), timestamp_columns=("day",)),
        TableSpec("b", sources=(csv("id", "1", name="b.csv"),)),
    ]
    reports = load_backfills(spark, specs, database, DAY)
    assert {name: (report.rows, report.rejected) for name, report in reports.items()} == {"a": (1, 1), "b": (1, 0)}
    assert read_table(spark, (database, "a_rejects")).first().text == "1,2,3"
    assert read_table(spark, (database, "b_rejects")) is None


def test_ship_dates_do_not_hide_rejects(spark, csv):
    path = csv("id,ship", "1,2024-01-05", "2,2024-03-05", "3,2024-01-05,EXTRA", "x,y,z")
    orders = backfill_orders(spark, [path], DAY, (), "ship", date(2024, 1, 1), date(2024, 1, 31), rejects=True)
    assert [row.id for row in accepted_rows(orders).collect()] == ["1"]
    assert rejected_rows(orders).count() == 2


# -- Pages ---------------------------------------------------------------------------------------


def pages(spark, *numbered):
    docs = []
    for number, records, total in numbered:
        about = {"number": number} | ({"totalPages": total} if total is not None else {})
        docs.append((json.dumps({"_embedded": {"customers": [{"id": r} for r in range(records)]}, "page": about}),))
    return spark.createDataFrame(docs, "doc string").repartition(3)


def plain_end(numbered, first=1):
    """Page by page, as a reader would."""
    by_number = {}
    for number, records, total in numbered:
        found = by_number.setdefault(number, [0, 1])
        by_number[number] = [max(found[0], records), max(found[1], 1 if total is None else total)]
    at = first
    while at in by_number:
        records, total = by_number[at]
        if at >= total or not records:
            return at
        at += 1
    return at - 1


@pytest.mark.parametrize("run", [2, 3, 7, 1000])
def test_last_page(spark, run):
    rnd = random.Random(run)
    for _ in range(4):
        size = rnd.randint(1, 60)
        numbered = [(n, rnd.choice([1, 2, 2, 2]), size) for n in range(1, size + 1)]
        for _ in range(rnd.randint(0, 2)):
            numbered.pop(rnd.randrange(len(numbered)))
            if not numbered:
                break
        if numbered and rnd.random() < 0.5:
            at = rnd.randrange(len(numbered))
            numbered[at] = (numbered[at][0], 0, size)
        numbered += [numbered[0]] * 5 if numbered else [(9, 1, 9)]
        assert last_page(pages(spark, *numbered), run=run) == plain_end(numbered)


def test_pages_until_end(spark):
    numbered = [(1, 2, 9), (2, 1, 9), (2, 1, 9), (3, 0, 9), (4, 5, 9), (None, 5, 9), (0, 5, 9), (-1, 5, 9)]
    kept = pages_until_end(pages(spark, *numbered))
    assert sorted(json.loads(row.doc)["page"]["number"] for row in kept.collect()) == [1, 2, 2, 3]
    # A landing of the same page that has records makes it a page with records.
    assert last_page(pages(spark, *numbered, (3, 1, 9))) == 4
    # Without a stated total a page is the last one.
    assert last_page(pages(spark, (1, 1, None), (2, 1, 9))) == 1
    assert last_page(pages(spark, (2, 1, 9))) == 0 and pages_until_end(pages(spark, (2, 1, 9))).count() == 0
    broken = spark.createDataFrame([("{bad",), (None,), ("[]",)], "doc string")
    assert pages_until_end(broken).count() == 0


def test_first_missing_looks_into_one_run(spark):
    numbers = spark.range(100_000).filter("id <> 70001").withColumnRenamed("id", "number")
    assert _first_missing(numbers, 10) == 70_001
    assert _first_missing(spark.range(1000).withColumnRenamed("id", "number"), 10) == 1000
    assert _first_missing(spark.range(1, 1000).withColumnRenamed("id", "number"), 10) == 0


# -- Discovery -----------------------------------------------------------------------------------

SAMPLES = {
    "tinyint": 1, "smallint": 2, "int": 3, "bigint": 4, "float": 1.5, "double": 2.5, "decimal(5,2)": "1.25", "decimal(12,4)": "2.5",
}


@pytest.mark.parametrize(
    "left, right, both",
    [
        ("tinyint", "smallint", "smallint"), ("int", "bigint", "bigint"), ("tinyint", "bigint", "bigint"), ("int", "double", "double"),
        ("smallint", "float", "double"), ("float", "double", "double"), ("decimal(5,2)", "decimal(12,4)", "decimal(12,4)"),
        ("int", "decimal(5,2)", "decimal(12,2)"), ("bigint", "decimal(12,4)", "decimal(24,4)"),
    ],
)
def test_values_survive_in_the_common_type(spark, database, tmp_path, left, right, both):
    for number, kind in enumerate((left, right, left)):
        row = f"CAST({SAMPLES[kind]} AS {kind}) AS v, named_struct('a-b', CAST({SAMPLES[kind]} AS {kind})) AS s, array(CAST({SAMPLES[kind]} AS {kind})) AS r"
        spark.sql(f"SELECT {number} AS id, {row}").coalesce(1).write.mode("append").parquet(f"{tmp_path}/lake/t")
    (found,) = discover_tables(spark, f"{tmp_path}/lake", database)
    assert (found.name, found.status, found.files) == ("t", "registered", 3)
    table = spark.table(f"{database}.t")
    assert table.schema["v"].dataType.simpleString() == both
    rows = {row.id: float(row.v) for row in table.collect()}
    assert rows == {0: float(SAMPLES[left]), 1: float(SAMPLES[right]), 2: float(SAMPLES[left])}
    assert {row.id: float(row.s["a-b"]) for row in table.collect()} == rows == {row.id: float(row.r[0]) for row in table.collect()}


@pytest.mark.parametrize("left, right", [("bigint", "double"), ("string", "int"), ("decimal(38,0)", "decimal(10,5)"), ("boolean", "int")])
def test_types_that_do_not_go_together(left, right):
    one, other = (T.StructType.fromDDL(f"a {kind}").fields[0].dataType for kind in (left, right))
    with pytest.raises(IncompatibleTypes, match="column x"):
        combine_types(one, other, "x")


def test_discovery_keeps_the_catalog_in_step(spark, database, tmp_path):
    lake = f"{tmp_path}/lake"

    def write(sql, path):
        spark.sql(sql).coalesce(1).write.mode("append").parquet(f"{lake}/{path}")

    def run():
        return {found.name: found.status for found in discover_tables(spark, lake, database)}

    write("SELECT 1 AS id", "orders/day=2024-01-01")
    write("SELECT 2L AS ID, 'x' AS more", "orders/day=2024-01-02")
    write("SELECT 'a' AS x", "odd")
    write("SELECT 1 AS x", "odd")
    write("SELECT 1 AS x", "going")
    spark.sql(f"CREATE TABLE {database}.other (a int) USING parquet LOCATION '{tmp_path}/other'")
    assert run() == {"orders": "registered", "odd": "failed", "going": "registered"}
    rows = sorted((row.id, row.more, str(row.day)) for row in spark.table(f"{database}.orders").collect())
    assert rows == [(1, None, "2024-01-01"), (2, "x", "2024-01-02")]
    # A folder vanishes, a partition comes and another goes.
    shutil.rmtree(f"{lake}/going")
    shutil.rmtree(f"{lake}/orders/day=2024-01-01")
    write("SELECT 3 AS id, true AS flag", "orders/day=2024-01-03")
    assert run() == {"orders": "registered", "odd": "failed", "going": "dropped"}
    rows = sorted((row.id, row.flag, str(row.day)) for row in spark.table(f"{database}.orders").collect())
    assert rows == [(2, None, "2024-01-02"), (3, True, "2024-01-03")]
    assert {row.tableName for row in spark.sql(f"SHOW TABLES IN {database}").collect()} == {"orders", "other"}
    shutil.rmtree(lake)
    assert run() == {"orders": "dropped"}


def test_deeper_levels_and_mixed_partitions(spark, database, tmp_path):
    spark.sql("SELECT 1 AS a").write.parquet(f"{tmp_path}/lake/x/one")
    spark.sql("SELECT 1 AS a").write.parquet(f"{tmp_path}/lake/y/two/p=1")
    spark.sql("SELECT 1 AS a").write.parquet(f"{tmp_path}/lake/y/two/q=1")
    found = {f.name: f.status for f in discover_tables(spark, f"{tmp_path}/lake", database, level=2)}
    assert found == {"x_one": "registered", "y_two": "failed"}


def test_an_entry_stays_until_the_new_one_is_there(spark, database, tmp_path):
    path = f"{tmp_path}/d"
    spark.sql("SELECT 1 AS a, named_struct('x-y', 1, 'z w', array(named_struct('p.q', 2))) AS s").write.parquet(path)
    register_dataset(spark, f"{database}.t", path)
    wrong = T.StructType([T.StructField("a", T.LongType()), T.StructField("a", T.StringType())])
    with pytest.raises(Exception):
        register_dataset(spark, f"{database}.t", path, schema=wrong)
    assert spark.table(f"{database}.t").first().s["x-y"] == 1
    spark.sql("SELECT 2L AS a").write.mode("overwrite").parquet(path)
    assert register_dataset(spark, f"{database}.t", path).schema["a"].dataType == T.LongType()
    assert len(spark.sql(f"SHOW TABLES IN {database}").collect()) == 1
