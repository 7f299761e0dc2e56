"""Queries on sinks: written, read back."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakezones.operators.columns import ingest_stamp, partition_stamp
from lakezones.operators.keys import surrogate_key
from lakezones.sinks.audit import AuditFailed, at_least, audited_overwrite, keeps, no_null_keys
from lakezones.sinks.bucketed import create_bucketed, merge_bucketed
from lakezones.sinks.compaction import compact_table
from lakezones.sinks.export import parquet_export
from lakezones.sinks.tables import append_partitions, create_table, merge_or_create, overwrite_or_create
from lakezones.sources.tables import read_table
from registered.keyed import MERGED_ORDERS, order_loads
from registered.registry import Tables, ntz, query
from registered.scalars import RUN_TIME


@query(MERGED_ORDERS)
def merge_table(t: Tables) -> DataFrame:
    table = (t.database(), "orders")
    for load in order_loads(t):
        merge_or_create(load, table, ["o_orderkey"])
    return t.spark.table(".".join(table))


@query(f"SELECT *, CAST(year(o_orderdate) AS int) AS order_year FROM ({MERGED_ORDERS})")
def merge_table_partitioned(t: Tables) -> DataFrame:
    table = (t.database(), "orders")
    for load in order_loads(t):
        yearly = load.withColumn("order_year", F.year("o_orderdate"))
        merge_or_create(yearly, table, ["o_orderkey", "order_year"], partition_column="order_year")
    return t.spark.table(".".join(table))


@query("SELECT * REPLACE (o_totalprice * 2 AS o_totalprice) FROM orders")
def overwrite_table(t: Tables) -> DataFrame:
    table = (t.database(), "orders")
    overwrite_or_create(t.orders, table)
    overwrite_or_create(t.orders.withColumn("o_totalprice", F.col("o_totalprice") * 2), table)
    return t.spark.table(".".join(table))


# The session replaces only partitions with rows, as many do; a full overwrite takes the others as well.
@query("""
SELECT o_orderkey, o_totalprice * 2 AS o_totalprice, CAST(year(o_orderdate) AS int) AS order_year
FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'
""")
def overwrite_partitioned(t: Tables) -> DataFrame:
    table, setting = (t.database(), "orders"), "spark.sql.sources.partitionOverwriteMode"
    yearly = t.orders.withColumn("order_year", F.year("o_orderdate"))
    first = yearly.select("o_orderkey", "o_totalprice", "order_year")
    create_table(first, table, partition_column="order_year")
    before = t.spark.conf.get(setting)
    t.spark.conf.set(setting, "dynamic")
    try:
        later = first.filter(F.col("order_year") >= 1999)
        overwrite_or_create(later.withColumn("o_totalprice", F.col("o_totalprice") * 2), table)
    finally:
        t.spark.conf.set(setting, before)
    return read_table(t.spark, table)


@query("""
SELECT o_orderkey, o_totalprice, CAST(NULL AS varchar) AS priority, '2024-02-01' AS "DT_PARTITION" FROM orders
UNION ALL
SELECT o_orderkey, o_totalprice, o_orderpriority, '2024-02-02' FROM orders
""")
def partitioned_append(t: Tables) -> DataFrame:
    table = (t.database(), "orders")
    first = t.orders.select("o_orderkey", "o_totalprice")
    append_partitions(partition_stamp(first, date(2024, 2, 1)), table)
    # The second day brings a column, and is run twice.
    second = t.orders.select("o_orderkey", F.col("o_orderpriority").alias("priority"), "o_totalprice")
    for _ in range(2):
        append_partitions(partition_stamp(second, date(2024, 2, 2)), table, replace=True)
    return t.spark.table(".".join(table))


@query("""
SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS "Customer_Key", o_custkey AS customer_id, o_orderdate AS created,
  o_orderstatus AS updated, o_orderpriority AS "Content", TIMESTAMP '2024-02-01 06:30:00' AS "Updated_On" FROM orders
""", name="parquet_export")
def gzip_export(t: Tables) -> DataFrame:
    records = t.orders.select(
        "o_orderkey", F.col("o_orderpriority").alias("content"), F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("created"), F.col("o_orderstatus").alias("updated"),
    )
    path = t.path("export")
    parquet_export(ingest_stamp(surrogate_key(records, ["created", "o_orderkey"]), RUN_TIME), path)
    return ntz(t.spark.read.parquet(path), "Updated_On")


@query("SELECT *, CAST(o_orderdate AS date) AS order_day FROM orders")
def created_table(t: Tables) -> DataFrame:
    table = (t.database(), "orders_by_day")
    create_table(t.orders.withColumn("order_day", F.col("o_orderdate").cast("date")), table)
    return t.spark.table(".".join(table))


# The merge of merge_table, on a table with 16 buckets.
@query(MERGED_ORDERS, name="merge_bucketed")
def merge_by_bucket(t: Tables) -> DataFrame:
    table = (t.database(), "orders")
    first, second = order_loads(t)
    create_bucketed(first, table, ["o_orderkey"], 16)
    merge_bucketed(second, table, ["o_orderkey"])
    return read_table(t.spark, table)


# A third of all rows shares a flag, whose bucket is hot: of it, lines with a new price replace all others.
@query("""
SELECT l_returnflag, l_orderkey, CASE WHEN l_returnflag = 'A' THEN -1.0 ELSE l_extendedprice END AS price FROM (
  SELECT l_returnflag, CASE WHEN l_returnflag = 'A' THEN 0 ELSE l_orderkey END AS l_orderkey, l_extendedprice FROM lineitem)
""")
def merge_hot_bucket(t: Tables) -> DataFrame:
    table = (t.database(), "lines")
    lines = t.lineitem.select("l_returnflag", "l_orderkey", F.col("l_extendedprice").alias("price"))
    create_bucketed(lines, table, ["l_returnflag"], 8, staged=True)
    batch = t.lineitem.filter("l_returnflag = 'A'").select(
        "l_returnflag", F.lit(0).cast("bigint").alias("l_orderkey"), F.lit(-1.0).alias("price")
    )
    merge_bucketed(batch.distinct(), table, ["l_returnflag"], hot_bytes=1)
    return read_table(t.spark, table)


# Small files of three years are put together; the fourth year has one file, which stays.
@query("""
SELECT o_orderkey, o_totalprice, CAST(year(o_orderdate) AS int) AS order_year, CAST(0 AS bigint) AS small_files FROM orders
""", name="compact_table")
def compacted(t: Tables) -> DataFrame:
    table = (t.database(), "orders")
    yearly = t.orders.select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("order_year"))
    create_table(yearly.filter("o_orderkey % 8 = 0"), table, partition_column="order_year")
    for rest in range(1, 8):
        append_partitions(yearly.filter(F.col("o_orderkey") % 8 == rest), table, "order_year")
    compaction = compact_table(t.spark, table)
    files = len(t.spark.table(".".join(table)).inputFiles())
    # One file for each year, as all of them together are smaller than a file should be.
    small = files - yearly.select("order_year").distinct().count()
    assert compaction.files_after == files
    return read_table(t.spark, table).withColumn("small_files", F.lit(small).cast("bigint"))


# An overwrite with null keys and too few rows is refused, and leaves the table as it was.
@query("""
SELECT o_orderkey, o_totalprice, (SELECT count(*) FROM orders) AS rows_after, CAST(0 AS bigint) AS null_keys,
  CAST(2 AS bigint) AS refused FROM orders
""", name="audited_overwrite")
def audited(t: Tables) -> DataFrame:
    table = (t.database(), "orders")
    orders = t.orders.select("o_orderkey", "o_totalprice")
    checks = [at_least(100), no_null_keys(["o_orderkey"]), keeps(0.9)]
    audit, refused = audited_overwrite(orders, table, checks), 0
    without_key = orders.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 2 == 0, F.col("o_orderkey")))
    for bad in (without_key, orders.filter("o_orderkey % 2 = 0")):
        try:
            audited_overwrite(bad, table, checks)
        except AuditFailed:
            refused += 1
    return read_table(t.spark, table).withColumns(
        {
            "rows_after": F.lit(audit.rows_after).cast("bigint"),
            "null_keys": F.lit(audit.counts["null_o_orderkey"]).cast("bigint"),
            "refused": F.lit(refused).cast("bigint"),
        }
    )
