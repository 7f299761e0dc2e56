"""Queries on casts, filters, payload fields and measures."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakezones.functions.casts import guarded_timestamp, iso_timestamp, numeric_key
from lakezones.functions.payload import TextField, extract_fields
from lakezones.operators import filters, measures
from lakezones.operators.columns import default_column, drop_payload, ingest_stamp, partition_stamp, project
from lakezones.plans.refined_customers import CUSTOMER_FIELDS
from lakezones.plans.refined_customers import refined_customers as refine
from registered.inputs import PAYLOADS
from registered.registry import Tables, ntz, query

RUN_TIME = datetime(2024, 2, 1, 6, 30)

# Every payload field on the checking engine.
REFINED = f"""
WITH payloads AS ({PAYLOADS}),
parsed AS (SELECT * EXCLUDE content, CASE WHEN json_valid(content) THEN content END AS c FROM payloads),
listed AS (
  SELECT *, list_filter(list_transform(coalesce(json_extract_string(c, '$.emails[*].value'), []),
                                       lambda x: trim(coalesce(x, ''))), lambda x: x <> '') AS l FROM parsed)
SELECT customer_key, customer_id, CAST(created AS timestamp) AS created, updated,
  TIMESTAMP '2024-02-01 06:30:00' AS updated_on,
  coalesce(left(array_to_string(list_filter(l, lambda x, i: list_position(l, x) = i), ','), 100), '') AS email,
  coalesce(left(trim(json_extract_string(c, '$.firstName')), 100), '') AS first_name,
  coalesce(left(trim(json_extract_string(c, '$.lastName')), 100), '') AS last_name,
  coalesce(left(trim(json_extract_string(c, '$.firstName') || ' ' || json_extract_string(c, '$.lastName')), 100), '') AS full_name,
  coalesce(left(trim(json_extract_string(c, '$.location')), 45), '') AS location,
  coalesce(left(trim(json_extract_string(c, '$._embedded.address.country')), 45), '') AS country_code,
  coalesce(left(trim(json_extract_string(c, '$._embedded.address.state')), 45), '') AS state,
  coalesce(left(trim(json_extract_string(c, '$._embedded.address.city')), 80), '') AS city,
  coalesce(left(trim(json_extract_string(c, '$._embedded.address.postalCode')), 45), '') AS postal_code
FROM listed
"""


def payloads(t: Tables) -> DataFrame:
    raw = t.sql(PAYLOADS, "customer")
    return ingest_stamp(raw.withColumn("created", F.col("created").cast("timestamp")), RUN_TIME, "updated_on")


@query(REFINED)
def refined_customers(t: Tables) -> DataFrame:
    return ntz(refine(payloads(t)), "created", "updated_on")


def _fields(t: Tables, *aliases: str) -> DataFrame:
    chosen = [field for field in CUSTOMER_FIELDS if field.alias in aliases]
    return extract_fields(payloads(t), chosen, keep=["customer_id"])


@query(f"SELECT customer_id, email FROM ({REFINED})")
def json_emails(t: Tables) -> DataFrame:
    return _fields(t, "email")


@query(f"SELECT customer_id, country_code, state, city, postal_code FROM ({REFINED})")
def json_address(t: Tables) -> DataFrame:
    return _fields(t, "country_code", "state", "city", "postal_code")


@query(f"SELECT customer_id, full_name FROM ({REFINED})")
def json_full_name(t: Tables) -> DataFrame:
    return _fields(t, "full_name")


@query("SELECT event_id, coalesce(left(trim(json_extract_string(props, '$.k')), 100), '') AS k FROM events")
def json_field(t: Tables) -> DataFrame:
    return extract_fields(t.events, [TextField("k", ("k",))], content="props", keep=["event_id"])


# Whole documents.
@query("""
SELECT doc_id, coalesce(trim(text), '') AS whole_text, coalesce(left(trim(lang), 45), '') AS language FROM documents
""")
def json_long_text(t: Tables) -> DataFrame:
    payload = t.documents.select("doc_id", F.to_json(F.struct("text", F.struct("lang").alias("meta"))).alias("content"))
    fields = [TextField("whole_text", ("text",), None), TextField("language", ("meta", "lang"), 45)]
    return extract_fields(payload, fields)


@query("SELECT o_custkey AS \"O_CUSTKEY\", o_orderkey FROM orders")
def fixed_projection(t: Tables) -> DataFrame:
    return project(t.orders, ["O_CUSTKEY", "o_orderkey"])


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def payload_dropped(t: Tables) -> DataFrame:
    return drop_payload(t.events, "props")


@query("SELECT *, TIMESTAMP '2024-02-01 06:30:00' AS updated_on FROM customer", name="default_column")
def default_column_added(t: Tables) -> DataFrame:
    added = default_column(t.customer, "updated_on", F.lit("2024-02-01 06:30:00").cast("timestamp_ntz"))
    return default_column(added, "UPDATED_ON", F.current_timestamp())


@query("SELECT *, TIMESTAMP '2024-02-01 06:30:00' AS \"Updated_On\", '2024-02-01' AS \"DT_PARTITION\" FROM customer", name="ingest_stamp")
def ingest_stamps(t: Tables) -> DataFrame:
    return ntz(partition_stamp(ingest_stamp(t.customer, RUN_TIME), RUN_TIME.date()), "Updated_On")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag || l_linestatus
    WHEN 'AF' THEN l_orderkey WHEN 'AO' THEN l_orderkey WHEN 'NF' THEN l_orderkey WHEN 'NO' THEN l_orderkey * 1000 END AS key
FROM lineitem
""")
def numeric_key_cast(t: Tables) -> DataFrame:
    spelled = t.sql(
        """
        SELECT l_orderkey, l_linenumber, l_partkey, CASE l_returnflag || l_linestatus
            WHEN 'AF' THEN CAST(l_orderkey AS string) WHEN 'AO' THEN '00' || CAST(l_orderkey AS string)
            WHEN 'NF' THEN CAST(l_orderkey AS string) || '.0' WHEN 'NO' THEN CAST(l_orderkey AS string) || 'e3'
            WHEN 'RF' THEN CAST(l_orderkey AS string) || '.5' ELSE 'x' || CAST(l_orderkey AS string) END AS text
        FROM lineitem""",
        "lineitem",
    )
    return spelled.select("l_orderkey", "l_linenumber", "l_partkey", numeric_key(F.col("text")).alias("key"))


@query("""
SELECT event_id, CASE event_type WHEN 'error' THEN ts WHEN 'click' THEN ts - INTERVAL 2 HOUR
                                 WHEN 'purchase' THEN date_trunc('day', ts) END AS at FROM events
""")
def iso_timestamp_cast(t: Tables) -> DataFrame:
    spelled = t.sql(
        """
        SELECT event_id, CASE event_type WHEN 'error' THEN replace(CAST(ts AS string), ' ', 'T') || 'Z'
            WHEN 'click' THEN replace(CAST(ts AS string), ' ', 'T') || '+02:00'
            WHEN 'purchase' THEN substring(CAST(ts AS string), 1, 10)
            WHEN 'view' THEN '2024-13-01T00:00:00Z' END AS text
        FROM events""",
        "events",
    )
    return ntz(spelled.select("event_id", iso_timestamp(F.col("text")).alias("at")), "at")


@query("SELECT event_id, CASE WHEN event_type = 'error' THEN date_trunc('second', ts) END AS at FROM events", name="guarded_timestamp")
def guarded_timestamp_cast(t: Tables) -> DataFrame:
    spelled = t.sql(
        """
        SELECT event_id, CASE event_type WHEN 'error' THEN substring(CAST(ts AS string), 1, 19)
            WHEN 'click' THEN substring(CAST(ts AS string), 1, 10)
            WHEN 'purchase' THEN replace(substring(CAST(ts AS string), 1, 19), ' ', 'T')
            WHEN 'view' THEN 'at ' || substring(CAST(ts AS string), 1, 19) END AS text
        FROM events""",
        "events",
    )
    return ntz(spelled.select("event_id", guarded_timestamp(F.col("text")).alias("at")), "at")


@query("""
SELECT c_custkey, CAST(DATE '1970-01-01' + CAST(floor(c_acctbal) AS int) AS timestamp) AS created
FROM customer WHERE c_acctbal >= 0 AND c_mktsegment <> 'BUILDING'
""")
def epoch_floor(t: Tables) -> DataFrame:
    spelled = t.sql(
        """
        SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'unknown'
            ELSE CAST(DATE '1970-01-01' + CAST(floor(c_acctbal) AS int) AS string) || 'T00:00:00Z' END AS text
        FROM customer""",
        "customer",
    )
    return ntz(filters.epoch_floor(spelled.select("c_custkey", iso_timestamp(F.col("text")).alias("created"))), "created")


KEYED_ORDERS = "SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_custkey END AS customer_id FROM orders"


@query(f"SELECT * FROM ({KEYED_ORDERS}) WHERE customer_id IS NOT NULL")
def null_key_reject(t: Tables) -> DataFrame:
    return filters.reject_null_keys(t.sql(KEYED_ORDERS, "orders"), ["customer_id"])


@query(f'SELECT count(*) AS "rows", count(*) FILTER (customer_id IS NULL) AS null_keys FROM ({KEYED_ORDERS})')
def null_key_counts(t: Tables) -> DataFrame:
    return measures.null_key_count(t.sql(KEYED_ORDERS, "orders"), ["customer_id"])


@query("SELECT * FROM events WHERE CAST(ts AS date) = (SELECT max(CAST(ts AS date)) FROM events)")
def latest_day_snapshot(t: Tables) -> DataFrame:
    return filters.latest_day(t.events, "ts")


@query("SELECT * FROM lineitem WHERE CAST(l_shipdate AS date) BETWEEN DATE '1997-01-01' AND DATE '1998-12-31'")
def shipdate_range(t: Tables) -> DataFrame:
    return filters.day_range(t.lineitem, "l_shipdate", date(1997, 1, 1), date(1998, 12, 31))


@query("SELECT strftime(max(ts), '%Y-%m-%dT%H:%M:%SZ') AS watermark FROM events")
def max_watermark(t: Tables) -> DataFrame:
    return measures.max_watermark(t.events, "ts")


@query('SELECT count(*) AS "rows" FROM lineitem')
def row_count(t: Tables) -> DataFrame:
    return measures.row_count(t.lineitem)


@query("""
SELECT count(*) FILTER (o_orderdate < TIMESTAMP '2000-01-01') AS rows_before, count(*) AS rows_after,
  abs(rows_after - rows_before) AS changed,
  CASE WHEN rows_after > rows_before THEN 'inserted' WHEN rows_after = rows_before THEN 'unchanged' ELSE 'deleted' END AS status
FROM orders
""")
def count_delta(t: Tables) -> DataFrame:
    return measures.count_delta(t.orders.filter(F.col("o_orderdate") < F.lit(date(2000, 1, 1))), t.orders)


@query('SELECT count(*) AS "rows", count(*) >= 100 AS success FROM customer')
def min_rows_check(t: Tables) -> DataFrame:
    return measures.min_rows_check(t.customer)


# The time as text in three forms: bare days, ISO with zone, with fraction.
@query("""
SELECT event_id, CASE event_id % 3 WHEN 0 THEN strftime(ts, '%Y-%m-%d') WHEN 1 THEN strftime(ts, '%Y-%m-%dT%H:%M:%SZ')
  ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') || '.500' END AS at
FROM events WHERE CAST(ts AS date) = (SELECT max(CAST(ts AS date)) FROM events)
""")
def latest_day_text(t: Tables) -> DataFrame:
    form = F.col("event_id") % 3
    at = (
        F.when(form == 0, F.date_format("ts", "yyyy-MM-dd"))
        .when(form == 1, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
        .otherwise(F.concat(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(".500")))
    )
    return filters.latest_day(t.events.select("event_id", at.alias("at")), "at")
