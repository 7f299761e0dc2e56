"""Whole loads: incremental batches, the three zones, the backfill and the stream."""

from __future__ import annotations

from collections import Counter
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakezones.operators.dedup import deduplicate_latest
from lakezones.operators.filters import is_empty, since
from lakezones.operators.keys import surrogate_key
from lakezones.operators.measures import max_watermark
from lakezones.plans.backfill import backfill_orders, load_backfill, load_backfills
from lakezones.plans.curated import load_curated
from lakezones.plans.raw_customers import latest_records, load_raw_customers, raw_records
from lakezones.plans.refined_customers import load_refined_customers
from lakezones.plans.runner import run_tables
from lakezones.session import stage
from lakezones.sinks.tables import append_partitions, create_table, merge_or_create, table_location
from lakezones.sources.pages import read_pages
from lakezones.sources.tables import read_table
from lakezones.specs import TableSpec
from lakezones.streaming.latest import latest_by_state
from lakezones.streaming.upserts import upsert_new_files
from lakezones.streaming.watermark import WatermarkStore
from registered.inputs import CHANGES, change_pages, landed, pages_of
from registered.registry import Tables, ntz, query
from registered.scalars import REFINED, RUN_TIME, payloads


@query("SELECT * FROM events")
def incremental_two_batches(t: Tables) -> DataFrame:
    table, state = (t.database(), "events"), WatermarkStore(t.spark, t.path("state"))
    had_landed = t.events.filter(F.col("ts") < F.lit(date(2024, 1, 20)))
    for landing in (had_landed, t.events):
        batch = stage(since(landing, "ts", state.read("events")))
        merge_or_create(batch, table, ["event_id"], staged=True)
        state.advance("events", max_watermark(batch, "ts").first()[0])
    return t.spark.table(".".join(table))


LATEST_CHANGES = f"""
SELECT * EXCLUDE r FROM (
  SELECT customer_id, created, updated, content,
    row_number() OVER (PARTITION BY customer_id ORDER BY updated DESC, content DESC) AS r
  FROM ({CHANGES}) WHERE customer_id IS NOT NULL AND created >= DATE '1970-01-01') WHERE r = 1
"""


@query(f"""
SELECT row_number() OVER (ORDER BY created, customer_id) AS customer_key, customer_id, CAST(created AS timestamp) AS created,
  updated, content, TIMESTAMP '2024-02-01 06:30:00' AS updated_on FROM ({LATEST_CHANGES})
""")
def raw_customers(t: Tables) -> DataFrame:
    table, state = (t.database(), "customers"), WatermarkStore(t.spark, t.path("state"))
    pages = read_pages(t.spark, landed(t, change_pages(t)))
    load_raw_customers(pages, table, state, RUN_TIME)
    # The second run reads what changed since the first one's watermark, which changes no row.
    load_raw_customers(pages, table, state, RUN_TIME)
    return ntz(t.spark.table(".".join(table)), "created", "updated_on")


# Changes of the lowest priority come without a time of change.
TIMELESS = f"""
SELECT o_orderkey, o_custkey, o_orderdate, customer_id, created,
  CASE WHEN o_orderpriority <> '5-LOW' THEN updated END AS updated,
  CASE WHEN o_orderpriority <> '5-LOW' THEN content ELSE replace(content, '"updatedAt"', '"changedAt"') END AS content
FROM ({CHANGES}) AS changes
"""


@query(f"""
SELECT row_number() OVER (ORDER BY created, customer_id) AS customer_key, customer_id, CAST(created AS timestamp) AS created,
  updated, content, TIMESTAMP '2024-02-01 06:30:00' AS updated_on
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY updated DESC NULLS LAST, content DESC) AS r
  FROM ({TIMELESS}) WHERE customer_id IS NOT NULL AND created >= DATE '1970-01-01') WHERE r = 1
""")
def raw_customers_full(t: Tables) -> DataFrame:
    table, state = (t.database(), "customers"), WatermarkStore(t.spark, t.path("state"))
    changes = t.sql(TIMELESS, "orders", "customer")
    pages = read_pages(t.spark, landed(t, pages_of(changes, "o_orderkey", "content", t.orders)))
    # A load since the watermark holds the records without a time, which replace no later ones.
    for full in (False, False, True):
        load_raw_customers(pages, table, state, RUN_TIME, full=full)
    return ntz(t.spark.table(".".join(table)), "created", "updated_on")


@query(f"SELECT * FROM ({REFINED})")
def refined_table(t: Tables) -> DataFrame:
    zone = t.database()
    create_table(payloads(t), (zone, "customers"))
    for _ in range(2):
        load_refined_customers(t.spark, (zone, "customers"), (zone, "refined_customers"))
    return ntz(t.spark.table(f"{zone}.refined_customers"), "created", "updated_on")


# The curated table holds the latest event per user of all days but the last, which is then merged.
@query("""
SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS r FROM events)
WHERE r = 1
""")
def curated_latest_merge(t: Tables) -> DataFrame:
    refined, curated = t.database(), t.database()
    spec = TableSpec("user_events", primary_keys=("user_id",))
    daily = deduplicate_latest(
        t.events.withColumn("day", F.col("ts").cast("date")), ["user_id", "day"], "ts", ties=["event_id"]
    )
    create_table(daily.drop("day"), (refined, spec.name))
    last_day = t.events.agg(F.max("ts").cast("date")).scalar()
    earlier = t.spark.table(f"{refined}.{spec.name}").filter(F.col("ts") < last_day)
    create_table(deduplicate_latest(earlier, "user_id", "ts", ties=["event_id"]), (curated, spec.name))
    load_curated(t.spark, spec, refined, curated, ingest_column="ts")
    return t.spark.table(f"{curated}.{spec.name}")


@query("""
SELECT CAST(l_orderkey AS varchar) AS order_id, CASE WHEN l_returnflag = 'A' THEN l_linestatus END AS line_status,
  CAST(l_quantity AS varchar) AS quantity, CASE WHEN l_returnflag <> 'A' THEN '00' || l_linenumber END AS line_number,
  CAST(CAST(l_shipdate AS date) AS varchar) AS ship_date, CASE WHEN l_returnflag <> 'R' THEN l_shipdate END AS order_date,
  CAST(NULL AS timestamp) AS arrival_date, '2024-02-01' AS "DT_PARTITION"
FROM lineitem WHERE CAST(l_shipdate AS date) BETWEEN DATE '1995-06-01' AND DATE '2001-06-30'
""")
def backfill_raw(t: Tables) -> DataFrame:
    # Three centers, each with a header of its own.
    ship = F.date_format("l_shipdate", "yyyy-MM-dd")
    written_at = {"A": "yyyy-MM-dd HH:mm:ss", "N": "yyyy-MM-dd HH:mm:ss", "R": "dd/MM/yyyy"}
    paths = []
    for flag, form in written_at.items():
        columns = {
            "order_id": F.col("l_orderkey"), "quantity": F.col("l_quantity"), "ship_date": ship,
            "order_date": F.date_format("l_shipdate", form), "arrival_date": ship,
        }
        if flag == "A":
            columns["line_status"] = F.col("l_linestatus")
        else:
            columns = {"line_number": F.concat(F.lit("00"), "l_linenumber")} | columns
        paths.append(t.path("center"))
        extract = t.lineitem.filter(F.col("l_returnflag") == flag)
        extract.select(*[c.alias(name) for name, c in columns.items()]).write.csv(paths[-1], header=True)
    table = (t.database(), "closed_orders")
    orders = backfill_orders(
        t.spark, paths, date(2024, 2, 1), ["order_date", "arrival_date"], "ship_date", date(1995, 6, 1), date(2001, 6, 30)
    )
    load_backfill(orders, table, replace=True)
    load_backfill(orders, table, replace=True)
    return ntz(t.spark.table(".".join(table)), "order_date", "arrival_date")


# Two tables, each from the extracts of its own centers and with its own time columns.
@query("""
SELECT 'orders' AS name, CAST(o_orderkey AS varchar) AS id, CAST(o_orderdate AS timestamp) AS day, '2024-02-01' AS "DT_PARTITION" FROM orders
UNION ALL SELECT 'lines', CAST(l_orderkey AS varchar), CAST(l_shipdate AS timestamp), '2024-02-01' FROM lineitem
""")
def backfill_tables(t: Tables) -> DataFrame:
    zone, specs = t.database(), []
    for name, column, source in (("orders", "o", t.orders), ("lines", "l", t.lineitem)):
        key, day = f"{column}_orderkey", "o_orderdate" if column == "o" else "l_shipdate"
        extract = source.select(F.col(key).alias("id"), F.date_format(day, "yyyy-MM-dd HH:mm:ss").alias("day"))
        early = F.col("day") < "1999"
        paths = []
        for part in (extract.filter(early), extract.filter(~early)):
            paths.append(t.path("center"))
            part.write.csv(paths[-1], header=True)
        specs.append(TableSpec(name, timestamp_columns=("day",), sources=tuple(paths)))
    load_backfills(t.spark, specs, zone, date(2024, 2, 1), multi_line=False)
    orders, lines = (
        read_table(t.spark, (zone, spec.name)).select(F.lit(spec.name).alias("name"), "id", "day", "DT_PARTITION")
        for spec in specs
    )
    return ntz(orders.unionByName(lines), "day")


@query(f"""
SELECT customer_id, CAST(created AS timestamp) AS created, updated, content AS "Content",
  TIMESTAMP '2024-02-01 06:30:00' AS "Updated_On" FROM ({LATEST_CHANGES})
""")
def latest_customer_records(t: Tables) -> DataFrame:
    return ntz(latest_records(raw_records(change_pages(t), RUN_TIME)), "created", "Updated_On")


# Times of change in several forms: with fractions and offsets, tied, or none at all.
TIMED = f"""
SELECT o_orderkey, o_custkey, o_orderdate, customer_id, created,
  CASE WHEN o_orderpriority = '5-LOW' THEN 'unknown'
       WHEN o_orderpriority = '4-NOT SPECIFIED' THEN substr(updated, 1, 10) || 'T00:00:00.500Z'
       WHEN o_orderpriority = '3-MEDIUM' THEN substr(updated, 1, 10) || 'T02:00:00+02:00'
       ELSE updated END AS updated,
  CAST(o_orderdate AS timestamp) + CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN INTERVAL '0.5' SECOND ELSE INTERVAL '0' SECOND END AS time,
  o_orderpriority, content
FROM (SELECT o.*, o_orderpriority AS p FROM ({CHANGES}) AS o) AS changes
"""
TIMED_RECORDS = f"""
SELECT *, '{{"id":' || CAST(customer_id AS string) || ',"createdAt":"' || CAST(created AS string) || 'T00:00:00Z","updatedAt":"' || updated
  || '","lastOrder":' || CAST(o_orderkey AS string) || '}}' AS record FROM ({TIMED}) AS timed WHERE customer_id IS NOT NULL
"""


@query(f"""
SELECT row_number() OVER (ORDER BY created, customer_id) AS customer_key, customer_id, CAST(created AS timestamp) AS created, updated,
  record AS content, TIMESTAMP '2024-02-01 06:30:00' AS updated_on, CAST(2 AS bigint) AS orders_of_arrival
FROM (SELECT *, row_number() OVER (PARTITION BY customer_id
    ORDER BY CASE WHEN updated <> 'unknown' THEN time END DESC NULLS LAST, record DESC) AS r
  FROM ({TIMED_RECORDS}) WHERE created >= DATE '1970-01-01') WHERE r = 1
""")
def raw_customers_times(t: Tables) -> DataFrame:
    """The records arrive in two loads, in either order, and again: the tables are the same."""
    records = stage(t.sql(TIMED_RECORDS, "orders", "customer").select("o_orderkey", "record"), "timed")
    odd = F.col("o_orderkey") % 2 == 1
    found = []
    for loads in ((records.filter(odd), records.filter(~odd), records), (records.filter(~odd), records.filter(odd))):
        table, state = (t.database(), "customers"), WatermarkStore(t.spark, t.path("state"))
        for load in loads:
            pages = read_pages(t.spark, landed(t, pages_of(load, "o_orderkey", "record", t.orders)))
            load_raw_customers(pages, table, state, RUN_TIME, full=True)
        found.append(t.spark.table(".".join(table)))
    # Customers are numbered as they come, so that only their numbers tell the orders of arrival apart.
    rest = [name for name in found[0].columns if name != "customer_key"]
    both = found[0].select(rest).unionByName(found[1].select(rest)).groupBy(rest).agg(F.count("*").alias("orders_of_arrival"))
    numbered = surrogate_key(both, ["created", "customer_id"])
    return ntz(numbered, "created", "updated_on")


# Old orders of the lowest priority land late, and some orders land again.
@query("""
WITH landed AS (SELECT *, o_orderpriority = '5-LOW' OR o_orderdate >= TIMESTAMP '1999-01-01' AS second FROM orders),
latest AS (SELECT * EXCLUDE (r, second) FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r
  FROM landed) WHERE r = 1),
bound AS (SELECT max(o_orderdate) - INTERVAL 30 DAY AS day FROM landed WHERE NOT second)
SELECT *, (SELECT count(*) FROM landed, bound WHERE second AND o_orderdate < day)
  + (SELECT count(*) FROM landed, bound WHERE NOT second AND o_orderkey % 3 = 0 AND o_orderdate < day) AS late, CAST(2 AS bigint) AS writes FROM latest
""")
def stream_latest_state(t: Tables) -> DataFrame:
    table, landing, checkpoint = (t.database(), "latest_orders"), t.path("landing"), t.path("checkpoint")
    state, late = WatermarkStore(t.spark, t.path("state")), 0
    second = (F.col("o_orderpriority") == "5-LOW") | (F.col("o_orderdate") >= F.lit(date(1999, 1, 1)))
    again = ~second & (F.col("o_orderkey") % 3 == 0)
    writes = set()
    # The third run finds nothing new, the fourth only what has landed before: neither writes the table.
    for arrived in (t.orders.filter(~second), t.orders.filter(second | again), None, t.orders.filter(second)):
        if arrived is not None:
            arrived.write.mode("append").parquet(landing)
        report = latest_by_state(
            t.spark, landing, t.orders.schema, lambda rows: rows, table, ["o_custkey"], "o_orderdate", checkpoint,
            state, "orders", ties=["o_orderkey"], delay="30 days", file_format="parquet",
        )
        late += report.late if len(writes) < 2 else 0
        writes.add(table_location(t.spark, table))
    return read_table(t.spark, table).withColumns(
        {"late": F.lit(late).cast("bigint"), "writes": F.lit(len(writes)).cast("bigint")}
    )


# The newest changes land first, one file to a batch.
@query("""
SELECT * EXCLUDE r FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS r FROM orders)
WHERE r = 1
""")
def stream_out_of_order(t: Tables) -> DataFrame:
    table, landing, checkpoint = (t.database(), "latest_orders"), t.path("landing"), t.path("checkpoint")
    newer = F.col("o_orderdate") >= F.lit(date(1999, 1, 1))
    for arrived in (t.orders.filter(newer), t.orders.filter(~newer)):
        arrived.coalesce(1).write.mode("append").parquet(landing)
        upsert_new_files(
            t.spark, landing, t.orders.schema, lambda rows: rows, table, ["o_custkey"], "o_orderdate", checkpoint,
            ties=["o_orderkey"], file_format="parquet", max_files=1,
        ).awaitTermination()
    return read_table(t.spark, table)


@query(f"""
SELECT customer_id, CAST(created AS timestamp) AS created, updated, content AS "Content",
  TIMESTAMP '2024-02-01 06:30:00' AS "Updated_On" FROM ({LATEST_CHANGES})
""")
def stream_upserts(t: Tables) -> DataFrame:
    table, landing, checkpoint = (t.database(), "customers"), t.path("landing"), t.path("checkpoint")
    changes = t.sql(CHANGES, "orders", "customer")
    early = F.col("o_orderdate") < F.lit(date(1999, 1, 1))
    for arrived in (changes.filter(early), changes.filter(~early)):
        pages_of(arrived, "o_orderkey", "content", t.orders).write.mode("append").text(landing)
        upsert_new_files(
            t.spark, landing, "doc string", lambda pages: raw_records(pages, RUN_TIME), table, ["customer_id"],
            "updated", checkpoint, ties=["Content"], times=["updated"],
        ).awaitTermination()
    return ntz(read_table(t.spark, table), "created", "Updated_On")


# The second run finds no changed record; the third, over an empty landing, changes neither table nor watermark.
@query("""
SELECT event_id, ts, user_id, CAST('2024-01-30T23:59:59Z' AS varchar) AS watermark FROM events
""")
def empty_gate(t: Tables) -> DataFrame:
    table, state = (t.database(), "events"), WatermarkStore(t.spark, t.path("state"))
    events = t.events.select("event_id", "ts", "user_id")
    merge_or_create(events, table, ["event_id"])
    state.advance("events", "2024-01-30T23:59:59Z")
    nothing = since(events, "ts", "2030-01-01T00:00:00Z")
    if not is_empty(nothing):
        merge_or_create(nothing, table, ["event_id"])
        state.advance("events", "2030-01-01T00:00:00Z")
    append_partitions(nothing, table, replace=True)
    return read_table(t.spark, table).withColumn("watermark", F.lit(state.read("events")))


# Of three tables one fails: the others are loaded, and the failure is raised at the end.
@query("""
SELECT 'customer' AS name, count(*) AS "rows", 1 AS failures FROM customer
UNION ALL SELECT 'supplier', count(*), 1 FROM supplier
""")
def run_several_tables(t: Tables) -> DataFrame:
    zone = t.database()

    def load(spec: TableSpec) -> None:
        source = t.part.select("absent") if spec.name == "part" else getattr(t, spec.name)
        create_table(source, (zone, spec.name))

    specs = [TableSpec(name, primary_keys=()) for name in ("customer", "part", "supplier")]
    failures = 0
    try:
        run_tables(specs, load)
    except ExceptionGroup as group:
        failures = len(group.exceptions)
    counts = [
        read_table(t.spark, (zone, name)).agg(
            F.lit(name).alias("name"), F.count("*").alias("rows"), F.lit(failures).alias("failures")
        )
        for name in ("customer", "supplier")
    ]
    return counts[0].unionByName(counts[1])


# Two tables at once: one fails the first time, one always, and one whose jobs would take too long is cancelled.
@query("""
SELECT 'customer' AS name, count(*) AS "rows", 2 AS tries, 'TableTimeout,ValueError' AS failures FROM customer
UNION ALL SELECT 'supplier', count(*), 1, 'TableTimeout,ValueError' FROM supplier
""")
def run_tables_at_once(t: Tables) -> DataFrame:
    zone, tries = t.database(), Counter()

    def load(spec: TableSpec) -> None:
        tries[spec.name] += 1
        if spec.name == "part" or (spec.name == "customer" and tries[spec.name] == 1):
            raise ValueError("the source does not answer")
        if spec.name == "orders":
            # Every task of this job sleeps; it ends as it is cancelled.
            slow = F.reflect(F.lit("java.lang.Thread"), F.lit("sleep"), F.lit(100).cast("bigint"))
            t.orders.select(slow.alias("slept")).write.format("noop").mode("overwrite").save()
        create_table(getattr(t, spec.name), (zone, spec.name))

    specs = [TableSpec(name) for name in ("orders", "customer", "part", "supplier")]
    failures = []
    try:
        run_tables(specs, load, at_most=2, retries=1, first_wait=0.1, timeout=20)
    except ExceptionGroup as group:
        failures = sorted(type(error).__name__ for error in group.exceptions)
    counts = [
        read_table(t.spark, (zone, name)).agg(
            F.lit(name).alias("name"), F.count("*").alias("rows"), F.lit(tries[name]).alias("tries"),
            F.lit(",".join(failures)).alias("failures"),
        )
        for name in ("customer", "supplier")
    ]
    return counts[0].unionByName(counts[1])
