"""Raw to refined customers: text columns out of the JSON payload."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakezones.fixed_values import (
    CITY_LENGTH,
    COUNTRY_LENGTH,
    EMAIL_LENGTH,
    LOCATION_LENGTH,
    NAME_LENGTH,
    POSTAL_CODE_LENGTH,
    REFINED_INPUT_COLUMNS,
    STATE_LENGTH,
)
from lakezones.functions.payload import JoinedField, ListField, TextField, extract_fields
from lakezones.operators.columns import default_column, project
from lakezones.operators.measures import LoadReport
from lakezones.session import stage
from lakezones.sinks.audit import Check, audited_overwrite
from lakezones.sinks.tables import ROW_LEVEL_FORMATS, Name, overwrite_or_create
from lakezones.sources.tables import read_table, table_row_count

log = logging.getLogger(__name__)

SORT_COLUMNS = ("customer_id", "customer_key")
ADDRESS = ("_embedded", "address")

CUSTOMER_FIELDS = (
    ListField("email", ("emails",), "value", length=EMAIL_LENGTH),
    TextField("first_name", ("firstName",), NAME_LENGTH),
    TextField("last_name", ("lastName",), NAME_LENGTH),
    JoinedField("full_name", (("firstName",), ("lastName",)), length=NAME_LENGTH),
    TextField("location", ("location",), LOCATION_LENGTH),
    TextField("country_code", (*ADDRESS, "country"), COUNTRY_LENGTH),
    TextField("state", (*ADDRESS, "state"), STATE_LENGTH),
    TextField("city", (*ADDRESS, "city"), CITY_LENGTH),
    TextField("postal_code", (*ADDRESS, "postalCode"), POSTAL_CODE_LENGTH),
)


def customer_columns(raw: DataFrame) -> DataFrame:
    """The refined columns of all raw customers, in no order."""
    stamped = default_column(raw, "updated_on", F.current_timestamp())
    return extract_fields(project(stamped, REFINED_INPUT_COLUMNS), CUSTOMER_FIELDS)


def refined_customers(raw: DataFrame) -> DataFrame:
    """The refined columns of all raw customers, sorted by customer."""
    return customer_columns(raw).orderBy(*SORT_COLUMNS)


def load_refined_customers(
    spark: SparkSession, raw_table: Name, refined_table: Name, provider: str = "parquet", checks: Iterable[Check] = ()
) -> LoadReport | None:
    """Rebuild the refined table; None if there is no raw table.

    With ``checks`` the new content is published only if it passes them.

    A global sort runs its input twice, the first time to find the bounds of its partitions. The
    refined columns are staged before it, so that the much larger payloads are read and parsed once.
    """
    raw = read_table(spark, raw_table)
    if raw is None:
        return None
    refined = stage(customer_columns(raw), "refined-customers").orderBy(*SORT_COLUMNS)
    checks = list(checks)
    if checks and provider in ROW_LEVEL_FORMATS:
        raise ValueError(f"{provider} tables are not audited before they are published")
    if checks:
        audit = audited_overwrite(refined, refined_table, checks)
        report = LoadReport(str(refined_table), audit.rows_before, audit.rows_after)
    else:
        before = table_row_count(spark, refined_table)
        overwrite_or_create(refined, refined_table, provider)
        report = LoadReport(str(refined_table), before, table_row_count(spark, refined_table))
    log.info(report.message())
    return report
