"""Landed pages and payloads derived from the given tables, and the queries on sources.

The SQL texts run unchanged on Spark and on the checking engine.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakezones.operators.columns import rename_columns, stringify_all
from lakezones.operators.filters import since
from lakezones.plans.backfill import backfill_orders, load_backfill
from lakezones.sources.delimited import read_text_csv, union_by_name
from lakezones.sources.discovery import FOUND_BELOW, discover_tables
from lakezones.sources.pages import flatten_pages, last_page, page_completeness, pages_until_end, read_pages
from lakezones.sources.tables import parquet_row_count, plain_path, read_table, register_dataset
from registered.registry import Tables, query

PAGE_SIZE = 50

# One JSON payload per customer: broken, absent, of the wrong type or with odd fields, by balance and nation.
PAYLOADS = """
SELECT c_custkey + 1 AS customer_key, c_custkey AS customer_id,
  DATE '1970-01-01' + CAST(floor(c_acctbal) AS int) AS created,
  CAST(DATE '2020-01-01' + CAST(floor(c_acctbal) AS int) AS string) || 'T00:00:00Z' AS updated,
  CASE WHEN c_acctbal < -900 THEN '{bad'
       WHEN c_acctbal < -800 THEN NULL
       WHEN c_acctbal < -700 THEN '[1,2]'
  ELSE '{"id":' || CAST(c_custkey AS string)
    || CASE WHEN c_nationkey = 11 THEN ',"firstName":null'
            WHEN c_nationkey = 12 THEN ',"firstName":12'
            WHEN c_nationkey = 13 THEN ''
            ELSE ',"firstName":"  F' || CAST(c_nationkey AS string) || ' "' END
    || CASE WHEN c_nationkey = 14 THEN ',"lastName":{"a":1}'
            WHEN c_nationkey = 15 THEN ',"LASTNAME":"X"'
            WHEN c_nationkey = 16 THEN ',"lastName":"' || repeat(c_mktsegment || ' ', 12) || '"'
            ELSE ',"lastName":"' || c_mktsegment || '"' END
    || CASE WHEN c_nationkey = 17 THEN '' ELSE ',"location":" ' || repeat(c_name || ' ', 4) || '"' END
    || CASE WHEN c_nationkey = 3 THEN ''
            WHEN c_nationkey = 4 THEN ',"emails":null'
            WHEN c_nationkey = 5 THEN ',"emails":"none"'
            WHEN c_nationkey = 6 THEN ',"emails":[]'
            WHEN c_nationkey = 7 THEN ',"emails":[{"value":"' || repeat('x', 60) || '"},{"value":"' || repeat('y', 60) || '"}]'
            ELSE ',"emails":[{"value":" b' || CAST(c_custkey AS string) || '@x.example "},{"value":"a@x.example"},'
              || '{"value":"A@x.example"},{"value":"b' || CAST(c_custkey AS string) || '@x.example"},{"value":""},{"value":null},{}]' END
    || CASE WHEN c_nationkey = 8 THEN ',"_embedded":{"address":null}'
            WHEN c_nationkey = 9 THEN ''
            WHEN c_nationkey = 10 THEN ',"_embedded":"none"'
            ELSE ',"_embedded":{"address":{"country":"N' || CAST(c_nationkey AS string) || '","state":" S",'
              || '"city":"Zürich ' || repeat(c_name, 5) || '","postalCode":"00' || CAST(c_custkey AS string) || '"}}' END
    || '}' END AS content
FROM customer
"""

# One customer record per order: the customer as it was after the order. Some ids are absent or no numbers.
CHANGES = """
SELECT o_orderkey, o_custkey, o_orderdate, o_orderpriority,
  CASE WHEN o_orderpriority = '1-URGENT' THEN NULL ELSE o_custkey END AS customer_id,
  DATE '1970-01-01' + CAST(floor(c_acctbal) AS int) AS created,
  CAST(CAST(o_orderdate AS date) AS string) || 'T00:00:00Z' AS updated,
  '{"id":' || CASE WHEN o_orderpriority <> '1-URGENT' THEN CAST(o_custkey AS string)
                   WHEN o_orderstatus = 'F' THEN 'null' ELSE '"n/a"' END
    || ',"createdAt":"' || CAST(DATE '1970-01-01' + CAST(floor(c_acctbal) AS int) AS string)
    || 'T00:00:00Z","updatedAt":"' || CAST(CAST(o_orderdate AS date) AS string)
    || 'T00:00:00Z","lastOrder":' || CAST(o_orderkey AS string) || '}' AS content
FROM orders JOIN customer ON o_custkey = c_custkey
"""


def pages_of(records: DataFrame, number: str, content: str, total: DataFrame) -> DataFrame:
    """Put JSON records into page documents, ``PAGE_SIZE`` consecutive numbers to a page.

    ``total`` holds the rows that the source states to have.
    """
    count = total.agg(F.count("*")).scalar()
    page = F.floor(F.col(number) / PAGE_SIZE).cast("bigint").alias("page")
    doc = F.concat(
        F.lit('{"_embedded":{"customers":['), F.array_join("records", ","), F.lit(']},"page":{"number":'),
        F.col("page") + 1, F.lit(f',"size":{PAGE_SIZE},"totalElements":'), count,
        F.lit(',"totalPages":'), F.ceil(count / PAGE_SIZE), F.lit("}}"),
    )
    return records.groupBy(page).agg(F.collect_list(content).alias("records")).select(doc.alias("doc"))


def change_pages(t: Tables) -> DataFrame:
    return pages_of(t.sql(CHANGES, "orders", "customer"), "o_orderkey", "content", t.orders)


def landed(t: Tables, pages: DataFrame) -> str:
    path = t.path("landing")
    pages.write.text(path)
    return path


@query("""
SELECT CAST(event_id AS varchar) AS customer_id, CAST(ts AS varchar) AS created, event_type AS updated,
  '{"id":' || event_id || ',"createdAt":"' || CAST(ts AS varchar) || '","updatedAt":"' || event_type
    || '","props":' || replace(props, ' ', '') || '}' AS "Content"
FROM events
""")
def json_page_flatten(t: Tables) -> DataFrame:
    record = F.to_json(
        F.struct(
            F.col("event_id").alias("id"), F.col("ts").cast("string").alias("createdAt"),
            F.col("event_type").alias("updatedAt"), F.from_json("props", "k bigint").alias("props"),
        )
    )
    pages = pages_of(t.events.select("event_id", record.alias("record")), "event_id", "record", t.events)
    return flatten_pages(read_pages(t.spark, landed(t, pages)))


@query("SELECT * FROM events WHERE ts >= TIMESTAMP '2024-01-15'")
def incremental_since(t: Tables) -> DataFrame:
    return since(t.events, "ts", "2024-01-15T00:00:00Z")


@query("""
WITH landed AS (SELECT DISTINCT l_orderkey FROM lineitem),
counts AS (
  SELECT count(DISTINCT l_orderkey // 50) AS pages_seen, count(*) AS records_seen,
    (SELECT CAST(ceil(count(*) / 50) AS bigint) FROM orders) AS pages_expected,
    (SELECT count(*) FROM orders) AS records_expected
  FROM landed)
SELECT *, pages_expected - pages_seen AS pages_missing, records_expected - records_seen AS records_missing FROM counts
""", name="page_completeness")
def page_completeness_report(t: Tables) -> DataFrame:
    # Orders without a line never landed, while the pages state the number of all orders.
    shipped = t.lineitem.select("l_orderkey").distinct()
    records = shipped.withColumn("record", F.to_json(F.struct(F.col("l_orderkey").alias("id"))))
    return page_completeness(read_pages(t.spark, landed(t, pages_of(records, "l_orderkey", "record", t.orders))))


@query("SELECT * FROM orders")
def table_scan(t: Tables) -> DataFrame:
    table = (t.database(), "orders_scan")
    register_dataset(t.spark, table, f"{t.folder}/orders.parquet")
    return read_table(t.spark, table)


@query("SELECT CAST(doc_id AS varchar) AS doc_id, text, lang, source, CAST(n_chars AS varchar) AS n_chars FROM documents")
def csv_all_string(t: Tables) -> DataFrame:
    path = t.path("csv")
    t.documents.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return read_text_csv(t.spark, path)


# One file per center. Some rows have one field too many, some one too few, some a separator inside quotes.
DAMAGED = """
SELECT l_orderkey, l_linenumber, l_returnflag, CASE WHEN l_linenumber = 2 THEN 'sent, ' || l_shipmode ELSE l_shipmode END AS mode,
  l_linenumber = 3 AS long, l_linenumber = 4 AS short FROM (
    SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus AS l_shipmode FROM lineitem)
"""


@query(f"""
WITH lines AS ({DAMAGED}),
written AS (SELECT *, CAST(l_orderkey AS varchar) AS id, CAST(l_linenumber AS varchar) AS line,
  l_orderkey || ',' || l_linenumber || ',' || l_returnflag || ',' || CASE WHEN contains(mode, ',') THEN '"' || mode || '"' ELSE mode END AS text FROM lines)
SELECT id, line, l_returnflag AS flag, CASE WHEN NOT short THEN mode END AS mode, CAST(NULL AS varchar) AS rejected,
  CAST(NULL AS int) AS expected, CAST(NULL AS int) AS found, '2024-02-01' AS "DT_PARTITION" FROM written WHERE NOT long
UNION ALL
SELECT NULL, NULL, NULL, NULL, text || ',EXTRA', 4, 5, '2024-02-01' FROM written WHERE long
""")
def csv_rejects(t: Tables) -> DataFrame:
    quoted_mode = F.when(F.contains("mode", F.lit(",")), F.concat(F.lit('"'), "mode", F.lit('"'))).otherwise(F.col("mode"))
    fields = [F.col(name).cast("string") for name in ("l_orderkey", "l_linenumber", "l_returnflag")]
    row = F.when(F.col("short"), F.array(*fields)).otherwise(F.array(*fields, quoted_mode))
    line = F.concat(F.array_join(row, ","), F.when(F.col("long"), F.lit(",EXTRA")).otherwise(F.lit("")))
    lines = t.sql(DAMAGED, "lineitem")
    paths = []
    for flag in "ANR":
        paths.append(t.path("center"))
        # The whole line is one column, which no separator or quote is added to.
        text = lines.filter(F.col("l_returnflag") == flag).select(line.alias("id,line,flag,mode"))
        text.write.options(header=True, sep="\x01", quote="\x02").csv(paths[-1])
    zone = t.database()
    orders = backfill_orders(t.spark, paths, date(2024, 2, 1), (), multi_line=False, rejects=True)
    report = load_backfill(orders, (zone, "lines"), rejects_table=(zone, "lines_rejects"))
    good, bad = read_table(t.spark, (zone, "lines")), read_table(t.spark, (zone, "lines_rejects"))
    assert report.rejected == bad.count()
    bad = bad.withColumnRenamed("text", "rejected").drop("source")
    return union_by_name([good, bad])


# Pages of 50 orders. One page never landed, a later one is empty, and some landed twice.
@query("""
SELECT o_orderkey, CAST(2 + (SELECT max(o_orderkey) FROM orders) // 150 AS bigint) AS last_page
FROM orders, (SELECT 1 AS copy UNION ALL SELECT 2) AS copies
WHERE o_orderkey // 50 < 2 + (SELECT max(o_orderkey) FROM orders) // 150 AND (copy = 1 OR (o_orderkey // 50) % 7 = 0)
""", name="pages_until_end")
def pages_until_gap(t: Tables) -> DataFrame:
    record = F.to_json(F.struct(F.col("o_orderkey").alias("id")))
    pages = pages_of(t.orders.select("o_orderkey", record.alias("record")), "o_orderkey", "record", t.orders)
    number = F.get_json_object("doc", "$.page.number").cast("bigint")
    # Orders have gaps of their own, which an empty page would stand for.
    missing = t.orders.agg((F.floor(F.max("o_orderkey") / 150) + 3).cast("bigint")).scalar()
    kept = pages.filter(number != missing)
    again = kept.filter((number - 1) % 7 == 0)
    ended = read_pages(t.spark, landed(t, kept.unionByName(again)))
    last = last_page(ended, run=16)
    records = flatten_pages(pages_until_end(ended, run=16), fields={"o_orderkey": "id"}, content="content")
    return records.select(F.col("o_orderkey").cast("bigint").alias("o_orderkey"), F.lit(last).cast("bigint").alias("last_page"))


# Three tables below one location, whose files hold a column in several types; one of them vanishes.
@query("""
SELECT 'orders' AS name, o_orderkey AS id, CASE WHEN o_orderstatus = 'F' THEN floor(o_totalprice) ELSE o_totalprice END AS amount,
  CAST(CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS varchar) AS note, o_orderstatus AS part, 2 AS tables FROM orders
UNION ALL
SELECT 'lines', l_orderkey, l_extendedprice, NULL, l_linestatus, 2 FROM lineitem
""", name="discover_tables")
def discovered(t: Tables) -> DataFrame:
    lake, zone = t.path("lake"), t.database()
    done = F.col("o_orderstatus") == "F"
    orders, lines = t.orders, t.lineitem
    orders.filter(done).select(F.col("o_orderkey").cast("int").alias("id"), F.floor("o_totalprice").cast("int").alias("amount")).write.parquet(
        f"{lake}/orders/part=F"
    )
    for status in ("O", "P"):
        orders.filter(F.col("o_orderstatus") == status).select(
            F.col("o_orderkey").alias("id"), F.col("o_totalprice").cast("decimal(12,2)").alias("amount"),
            F.col("o_orderpriority").alias("note"),
        ).write.parquet(f"{lake}/orders/part={status}")
    for status in ("F", "O"):
        lines.filter(F.col("l_linestatus") == status).select(
            F.col("l_orderkey").alias("id"), F.col("l_extendedprice").cast("decimal(14,2)").alias("amount")
        ).write.parquet(f"{lake}/lines/part={status}")
    # Of the same location, with an entry from an earlier run; its files are gone now.
    t.region.write.parquet(f"{lake}-earlier/regions")
    register_dataset(t.spark, (zone, "regions"), f"{lake}-earlier/regions")
    t.spark.sql(f"ALTER TABLE {zone}.regions SET TBLPROPERTIES ('{FOUND_BELOW}' = '{plain_path(lake)}')")
    discover_tables(t.spark, lake, zone)
    tables = t.spark.sql(f"SHOW TABLES IN {zone}").count()
    frames = [
        read_table(t.spark, (zone, name)).withColumns({"name": F.lit(name), "tables": F.lit(tables)}) for name in ("orders", "lines")
    ]
    both = union_by_name(frames)
    return both.withColumns({"amount": F.col("amount").cast("double"), "part": F.col("part").cast("string")})


@query("SELECT (SELECT count(*) FROM lineitem) AS found_rows, 0 AS missing_rows", name="parquet_row_count")
def parquet_row_counts(t: Tables) -> DataFrame:
    found = parquet_row_count(t.spark, f"{t.folder}/lineitem.parquet")
    missing = parquet_row_count(t.spark, t.path("missing"))
    return t.spark.range(1).select(F.lit(found).cast("bigint").alias("found_rows"), F.lit(missing).alias("missing_rows"))


@query("""
SELECT o_orderkey AS id, o_custkey AS customer, CAST(NULL AS double) AS price, DATE '2024-01-01' AS load_day FROM orders
UNION ALL
SELECT l_orderkey, NULL, l_extendedprice, DATE '2024-01-02' FROM lineitem
""")
def schema_discovery(t: Tables) -> DataFrame:
    path, table = t.path("discover"), (t.database(), "found")
    orders = t.orders.select(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer"))
    orders.write.parquet(f"{path}/load_day=2024-01-01")
    register_dataset(t.spark, table, path, ("load_day",))
    lines = t.lineitem.select(F.col("l_orderkey").alias("id"), F.col("l_extendedprice").alias("price"))
    lines.write.parquet(f"{path}/load_day=2024-01-02")
    return register_dataset(t.spark, table, path, ("load_day",))


@query("""
SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment, CAST(NULL AS double) AS balance FROM customer
UNION ALL
SELECT s_suppkey, s_name, NULL, s_acctbal FROM supplier
""", name="union_by_name")
def sources_by_name(t: Tables) -> DataFrame:
    customers = rename_columns(t.customer, {"c_custkey": "id", "c_name": "name", "c_mktsegment": "segment"})
    suppliers = rename_columns(t.supplier, {"s_suppkey": "id", "s_name": "name", "s_acctbal": "balance"})
    return union_by_name([customers.select("id", "name", "segment"), suppliers.select("balance", "name", "id")])


@query("""
SELECT p_partkey AS part_id, p_name AS "part.name", p_brand AS p_brand, p_type AS p_type, p_size AS "part.size",
  p_retailprice AS p_retailprice FROM part
""", name="rename_columns")
def renamed_columns(t: Tables) -> DataFrame:
    return rename_columns(t.part, {"p_partkey": "part_id", "p_name": "part.name", "p_size": "part.size", "absent": "x"})


@query("""
SELECT CAST(o_orderkey AS varchar) AS o_orderkey, CAST(o_custkey AS varchar) AS o_custkey, o_orderstatus,
  CAST(o_totalprice AS varchar) AS o_totalprice, CAST(o_orderdate AS varchar) AS o_orderdate, o_orderpriority
FROM orders
""", name="stringify_all")
def stringified(t: Tables) -> DataFrame:
    return stringify_all(t.orders)
