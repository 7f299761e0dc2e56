"""Queries on deduplication, numbering, merges and windows."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakezones.operators import dedup
from lakezones.operators.compare import table_diff
from lakezones.operators.intervals import join_windows
from lakezones.operators.keys import surrogate_key as numbered
from lakezones.operators.measures import preview
from lakezones.operators.merge import check_cardinality, merge_frames
from lakezones.operators.windows import assign_window, windows_of, worklist
from lakezones.session import stage
from registered.registry import Tables, query


@query("""
SELECT * EXCLUDE r FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders) WHERE r = 1
""")
def dedup_latest_row_number(t: Tables) -> DataFrame:
    return dedup.deduplicate_latest(t.orders, "o_custkey", "o_orderdate", ties=["o_orderkey"])


@query("""
SELECT * EXCLUDE r FROM (
  SELECT *, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC) AS r FROM orders) WHERE r = 1
""")
def dedup_latest_dense_rank(t: Tables) -> DataFrame:
    return dedup.deduplicate_latest(t.orders, "o_custkey", "o_orderdate", "dense_rank")


@query('SELECT l_orderkey, l_linenumber, count(*) AS "rows" FROM lineitem GROUP BY ALL HAVING count(*) > 1')
def duplicate_keys(t: Tables) -> DataFrame:
    return dedup.duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("SELECT event_id, ts, row_number() OVER (ORDER BY ts, event_id) AS event_key FROM events")
def surrogate_key(t: Tables) -> DataFrame:
    return numbered(t.events.select("event_id", "ts"), ["ts", "event_id"], "event_key")


# A third of all lines shares a flag, which comes first in the order.
@query("""
SELECT l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice,
  1000 + row_number() OVER (ORDER BY l_returnflag, l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) - 1 AS line_key
FROM lineitem
""")
def surrogate_key_skewed(t: Tables) -> DataFrame:
    columns = ["l_returnflag", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"]
    return numbered(t.lineitem.select(columns), columns, "line_key", start_key=1000)


@query("SELECT * FROM orders ORDER BY o_orderkey LIMIT 5")
def preview_top5(t: Tables) -> DataFrame:
    return preview(t.orders, "o_orderkey")


def first_and_second_load(df: DataFrame, day: str) -> tuple[DataFrame, DataFrame]:
    """What was loaded until 2000, and what a later extract since 1999 returns."""
    first = df.filter(F.col(day) < F.lit(date(2000, 1, 1)))
    second = df.filter(F.col(day) >= F.lit(date(1999, 1, 1)))
    return first, second


def merged_sql(table: str, day: str, keys: list[str], columns: dict[str, str]) -> str:
    on = " AND ".join(f"s.{key} = o.{key}" for key in keys)
    values = ", ".join(
        f"CASE WHEN s.{keys[0]} IS NOT NULL THEN {changed} ELSE o.{name} END AS {name}" for name, changed in columns.items()
    )
    return f"""
SELECT {values}
FROM (SELECT * FROM {table} WHERE {day} < TIMESTAMP '2000-01-01') o
FULL JOIN (SELECT * FROM {table} WHERE {day} >= TIMESTAMP '1999-01-01') s ON {on}
"""


MERGED_ORDERS = merged_sql(
    "orders",
    "o_orderdate",
    ["o_orderkey"],
    {
        "o_orderkey": "s.o_orderkey",
        "o_custkey": "s.o_custkey",
        "o_orderstatus": "s.o_orderstatus",
        "o_totalprice": "s.o_totalprice * 2",
        "o_orderdate": "s.o_orderdate",
        "o_orderpriority": "s.o_orderpriority",
    },
)


def order_loads(t: Tables) -> tuple[DataFrame, DataFrame]:
    first, second = first_and_second_load(t.orders, "o_orderdate")
    return first, second.withColumn("o_totalprice", F.col("o_totalprice") * 2)


@query(MERGED_ORDERS)
def merge_upsert(t: Tables) -> DataFrame:
    target, batch = order_loads(t)
    check_cardinality(target, batch, ["o_orderkey"])
    return merge_frames(target, batch, ["o_orderkey"])


LATEST_LINES = """(SELECT * EXCLUDE r FROM (
  SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_extendedprice DESC) AS r FROM lineitem WHERE {}) WHERE r = 1)"""


@query(f"""
SELECT coalesce(s.l_orderkey, o.l_orderkey) AS l_orderkey, coalesce(s.l_linenumber, o.l_linenumber) AS l_linenumber,
  coalesce(s.l_quantity + 1000, o.l_quantity) AS l_quantity, coalesce(s.l_shipdate, o.l_shipdate) AS l_shipdate
FROM {LATEST_LINES.format("l_shipdate < TIMESTAMP '2000-01-01'")} o
FULL JOIN {LATEST_LINES.format("l_shipdate >= TIMESTAMP '1999-01-01'")} s
  ON s.l_orderkey = o.l_orderkey AND s.l_linenumber = o.l_linenumber
""")
def merge_upsert_composite(t: Tables) -> DataFrame:
    keys = ["l_orderkey", "l_linenumber"]

    def latest(lines: DataFrame) -> DataFrame:
        kept = dedup.deduplicate_latest(lines, keys, "l_shipdate", ties=["l_partkey", "l_suppkey", "l_extendedprice"])
        return kept.select(*keys, "l_quantity", "l_shipdate")

    first, second = first_and_second_load(t.lineitem, "l_shipdate")
    batch = latest(second).withColumn("l_quantity", F.col("l_quantity") + 1000)
    return merge_frames(stage(latest(first)), stage(batch), keys)


@query("""
WITH windows AS (
  SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS date)), max(CAST(l_shipdate AS date)), INTERVAL 2 DAY)) AS date) AS start_date
  FROM lineitem)
SELECT start_date, start_date + 1 AS end_date, count(l_shipdate) AS lines
FROM windows LEFT JOIN lineitem ON CAST(l_shipdate AS date) BETWEEN start_date AND start_date + 1 GROUP BY ALL
""")
def date_windows(t: Tables) -> DataFrame:
    windows = windows_of(t.lineitem, "l_shipdate")
    days = t.lineitem.groupBy(F.col("l_shipdate").cast("date").alias("day")).agg(F.count("*").alias("lines"))
    covered = windows.withColumn("day", F.explode(F.sequence("start_date", "end_date")))
    return (
        covered.join(days, "day", "left")
        .groupBy("start_date", "end_date")
        .agg(F.coalesce(F.sum("lines"), F.lit(0)).cast("bigint").alias("lines"))
    )


@query("""
SELECT DATE '1995-01-01' + CAST(date_diff('day', DATE '1995-01-01', CAST(l_shipdate AS date)) // 2 * 2 AS int) AS start_date,
  start_date + 1 AS end_date, count(*) AS lines, max(l_extendedprice) AS top_price
FROM lineitem GROUP BY ALL
""")
def backfill_by_window(t: Tables) -> DataFrame:
    placed = assign_window(t.lineitem, "l_shipdate", date(1995, 1, 1), date(2001, 12, 31))
    return placed.groupBy("start_date", "end_date").agg(
        F.count("*").alias("lines"), F.max("l_extendedprice").alias("top_price")
    )


@query("""
WITH windows AS (
  SELECT CAST(unnest(generate_series(min(CAST(l_shipdate AS date)), max(CAST(l_shipdate AS date)), INTERVAL 2 DAY)) AS date) AS start_date
  FROM lineitem)
SELECT n_nationkey, n_name, start_date, start_date + 1 AS end_date FROM nation CROSS JOIN windows
""")
def backfill_worklist(t: Tables) -> DataFrame:
    first = t.lineitem.agg(F.min("l_shipdate")).scalar()
    last = t.lineitem.agg(F.max("l_shipdate")).scalar()
    return worklist(t.nation.select("n_nationkey", "n_name"), first, last)


# Promotions of one to sixty days, and one of all times, for each priority: they overlap and leave gaps.
PROMOTIONS = """
SELECT c_custkey AS promotion, DATE '1995-01-01' + CAST(c_custkey * 17 % 2500 AS int) AS first_day,
  DATE '1995-01-01' + CAST(c_custkey * 17 % 2500 + c_nationkey * 3 % 60 AS int) AS last_day FROM customer WHERE c_custkey % 5 = 0
UNION ALL SELECT -1, DATE '1900-01-01', DATE '2100-01-01'
UNION ALL SELECT -2, DATE '2000-01-01', DATE '1999-01-01'
UNION ALL SELECT -3, NULL, DATE '2000-01-01'
"""


@query(f"""
SELECT o_orderkey, o_orderdate, promotion, first_day, last_day FROM orders
JOIN ({PROMOTIONS}) ON CAST(o_orderdate AS date) BETWEEN first_day AND last_day
""")
def events_in_windows(t: Tables) -> DataFrame:
    return join_windows(
        t.orders.select("o_orderkey", "o_orderdate"), "o_orderdate", t.sql(PROMOTIONS, "customer"), "first_day", "last_day"
    )


# Of a later state some orders are gone, some have another price, and some are new.
LATER_ORDERS = """
SELECT CASE WHEN o_orderkey % 101 = 0 THEN -o_orderkey - 1 ELSE o_orderkey END AS o_orderkey, o_custkey,
  CASE WHEN o_orderkey % 211 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
  CASE WHEN o_orderkey % 307 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus
FROM orders WHERE o_orderkey % 97 <> 0
"""


@query(f"""
WITH before AS (SELECT o_orderkey, o_custkey, o_totalprice, o_orderstatus FROM orders), after AS ({LATER_ORDERS})
SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
  CASE WHEN b.o_orderkey IS NULL THEN 'inserted' WHEN a.o_orderkey IS NULL THEN 'deleted' ELSE 'updated' END AS status,
  CASE WHEN b.o_orderkey IS NULL THEN 0 ELSE 1 END AS rows_before, CASE WHEN a.o_orderkey IS NULL THEN 0 ELSE 1 END AS rows_after
FROM before b FULL JOIN after a ON b.o_orderkey = a.o_orderkey
WHERE b.o_orderkey IS NULL OR a.o_orderkey IS NULL OR (b.o_custkey, b.o_totalprice, b.o_orderstatus) IS DISTINCT FROM
  (a.o_custkey, a.o_totalprice, a.o_orderstatus)
""", name="table_diff")
def changed_orders(t: Tables) -> DataFrame:
    before = t.orders.select("o_orderkey", "o_custkey", "o_totalprice", "o_orderstatus")
    return table_diff(before, t.sql(LATER_ORDERS, "orders"), ["o_orderkey"]).changes
