import json

import pytest

from lakezones.jobs import parser, run, table_spec
from lakezones.sources.pages import IncompleteLanding
from lakezones.sources.tables import read_table


def test_three_zones(spark, database, tmp_path, rows):
    landing = tmp_path / "landing"
    landing.mkdir()

    def land(name, *customers):
        (landing / name).write_text(json.dumps({"_embedded": {"customers": list(customers)}}, indent=1))

    def load(*more):
        run(spark, ["source-to-raw", "--landing", str(landing), "--whole-files", "--table", f"{database}.customers",
                    "--state", str(tmp_path / "state"), *more])
        run(spark, ["raw-to-refined", "--raw-table", f"{database}.customers", "--refined-table", f"{database}.refined"])
        return rows(read_table(spark, f"{database}.refined").select("customer_key", "customer_id", "first_name"))

    when = "2024-01-0{}T00:00:00Z"
    land("1", {"id": 5, "createdAt": when.format(1), "updatedAt": when.format(1), "firstName": " Ann "})
    assert load() == [(1, 5, "Ann")]
    land("2", {"id": 5, "createdAt": when.format(1), "updatedAt": when.format(2), "firstName": "Anna"},
              {"id": 4, "createdAt": when.format(1), "updatedAt": when.format(2)})
    assert load() == [(1, 5, "Anna"), (2, 4, "")]
    assert load("--full") == [(1, 5, "Anna"), (2, 4, "")]


def test_backfill_and_curated(spark, database, tmp_path, rows):
    (tmp_path / "centers.csv").write_text("center_id\n01\n02\n")
    run(spark, ["worklist", "--centers", str(tmp_path / "centers.csv"), "--output", str(tmp_path / "work"),
                "--start", "2024-01-01", "--end", "2024-01-03"])
    work = spark.read.json(str(tmp_path / "work"))
    assert rows(work, "center_id", "start_date", "end_date") == [
        (c, s, e) for c in ("01", "02") for s, e in (("2024-01-01", "2024-01-02"), ("2024-01-03", "2024-01-04"))
    ]
    (tmp_path / "01.csv").write_text("order_id,order_date\na,2024-01-01 08:00:00\n")
    (tmp_path / "02.csv").write_text("order_date,order_id\n2024-01-02 08:00:00,b\n")
    run(spark, ["backfill", "--source", str(tmp_path / "01.csv"), "--source", str(tmp_path / "02.csv"),
                "--table", f"{database}.orders", "--run-day", "2024-02-01", "--timestamp-column", "order_date"])
    spark.sql(f"CREATE DATABASE {database}_c LOCATION '{tmp_path / 'curated'}'")
    try:
        run(spark, ["refined-to-curated", "--refined-database", database, "--curated-database", f"{database}_c",
                    "--table", "orders:order_id", "--ingest-column", "order_date"])
        assert rows(spark.table(f"{database}_c.orders"), "order_id") == [("b",)]
    finally:
        spark.sql(f"DROP DATABASE {database}_c CASCADE")


def test_stream_and_several_tables(spark, database, tmp_path, rows):
    landing, checkpoint = tmp_path / "landing", str(tmp_path / "checkpoint")
    landing.mkdir()
    for number in (2, 1):
        record = {"id": 5, "createdAt": "2024-01-01T00:00:00Z", "updatedAt": f"2024-01-0{number}T00:00:00Z"}
        page = {"number": 1, "size": 1, "totalElements": 2, "totalPages": 2}
        (landing / str(number)).write_text(json.dumps({"_embedded": {"customers": [record]}, "page": page}) + "\n")
        run(spark, ["stream-customers", "--landing", str(landing), "--table", f"{database}.latest", "--checkpoint", checkpoint])
    assert rows(read_table(spark, f"{database}.latest"), "customer_id", "updated") == [(5, "2024-01-02T00:00:00Z")]
    with pytest.raises(IncompleteLanding):
        run(spark, ["source-to-raw", "--landing", str(landing), "--table", f"{database}.customers", "--state",
                    str(tmp_path / "state"), "--require-complete"])
    assert read_table(spark, f"{database}.customers") is None
    (tmp_path / "a.csv").write_text("id,at\n1,2024-01-01 08:00:00\n")
    config = [{"name": name, "sources": [str(tmp_path / "a.csv")], "timestamp_columns": ["at"]} for name in ("x", "y")]
    (tmp_path / "tables.json").write_text(json.dumps(config))
    run(spark, ["backfill-tables", "--tables", str(tmp_path / "tables.json"), "--database", database, "--single-line"])
    assert [read_table(spark, f"{database}.{name}").count() for name in ("x", "y")] == [1, 1]
    with pytest.raises(ValueError, match="one refined table"):
        run(spark, ["raw-to-refined", "--raw-table", "a.b", "--raw-table", "a.c", "--refined-table", "a.d"])


def test_arguments():
    assert table_spec("t:a,b").primary_keys == ("a", "b")
    for text in ("t", ":a", "t:"):
        with pytest.raises(ValueError):
            table_spec(text)
    with pytest.raises(SystemExit):
        parser().parse_args(["backfill"])
