"""Landed pages of a paged JSON API, one document per row."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from lakezones.session import stage

# Where a page keeps its records, and the record fields that become columns.
RECORD_LIST = ("_embedded", "customers")
RECORD_FIELDS = {"customer_id": "id", "created": "createdAt", "updated": "updatedAt"}
PAGE_TOTALS = "page struct<number: bigint, size: bigint, totalElements: bigint, totalPages: bigint>"


def read_pages(spark: SparkSession, path: str, whole_files: bool = False) -> DataFrame:
    """Pages as column ``doc``: one per line, or one per file for pages that span lines."""
    return spark.read.text(path, wholetext=whole_files).withColumnRenamed("value", "doc")


def _list_schema(path: tuple[str, ...]) -> str:
    schema = "array<string>"
    for name in reversed(path[1:]):
        schema = f"struct<`{name}`: {schema}>"
    return f"`{path[0]}` {schema}"


def _record_list(page: Column, path: tuple[str, ...]) -> Column:
    for name in path:
        page = page[name]
    return page


def flatten_pages(
    pages: DataFrame,
    doc: str = "doc",
    path: tuple[str, ...] = RECORD_LIST,
    fields: Mapping[str, str] = RECORD_FIELDS,
    content: str = "Content",
) -> DataFrame:
    """One row per record of each page: the named fields as text and the whole record as JSON text.

    A page without the record list gives no rows, a record without a field gives null. Records
    are parsed inside the generator: a filter on a field would otherwise be pushed below the
    projection and parse the record once more.
    """
    schema = ", ".join(f"`{name}` string" for name in fields.values())
    texts = _record_list(F.from_json(F.col(doc), _list_schema(path)), path)
    records = F.transform(
        texts, lambda text: F.struct(F.from_json(text, schema).alias("_record"), text.alias(content))
    )
    return pages.select(F.inline(records)).select(
        *[F.col("_record")[name].alias(alias) for alias, name in fields.items()], content
    )


# Page numbers, or full runs of them, that are looked at together when the first gap is searched.
RUN_OF_PAGES = 10_000


def pages_until_end(
    pages: DataFrame,
    doc: str = "doc",
    path: tuple[str, ...] = RECORD_LIST,
    first: int = 1,
    run: int = RUN_OF_PAGES,
) -> DataFrame:
    """The pages that a reader meets who starts at page ``first`` and goes on page by page.

    Such a reader stops behind a page whose number reaches the total that it states (1 where it
    states none), at a page without records, and before a page that never landed. Pages beyond that
    place, before the first one or without a number are left out; pages that landed several times
    all stay, and count as empty only if each of them is.
    """
    number = _page_number(F.col(doc))
    end = last_page(pages, doc, path, first, run)
    return pages.filter(number.between(first, end))


def _page_number(doc: Column) -> Column:
    return F.from_json(doc, PAGE_TOTALS)["page"]["number"]


def last_page(
    pages: DataFrame, doc: str = "doc", path: tuple[str, ...] = RECORD_LIST, first: int = 1, run: int = RUN_OF_PAGES
) -> int:
    """The number of the last page of ``pages_until_end``; ``first - 1`` if the first page is missing.

    The first gap is found without bringing the numbers into one order: they are counted in runs
    of ``run``, full runs are counted the same way until few are left, and then only the first
    run that is not full is looked into, level by level. The driver sees at most ``run`` numbers.
    """
    parsed = pages.select(F.from_json(F.col(doc), f"{_list_schema(path)}, {PAGE_TOTALS}").alias("_doc"))
    landed = parsed.select(
        F.col("_doc.page.number").alias("number"),
        F.coalesce(F.size(_record_list(F.col("_doc"), path)), F.lit(0)).alias("records"),
        F.coalesce(F.col("_doc.page.totalPages"), F.lit(1)).alias("total"),
    ).filter(F.col("number") >= first)
    # Read once; one small row per page.
    numbered = stage(landed.groupBy("number").agg(F.max("records").alias("records"), F.max("total").alias("total")), "pages")
    stops = numbered.agg(
        F.min(F.when(F.col("records") <= 0, F.col("number"))).alias("empty"),
        F.min(F.when(F.col("number") >= F.col("total"), F.col("number"))).alias("last"),
    ).first()
    gap = first + _first_missing(numbered.select((F.col("number") - first).alias("number")), run)
    return min([gap - 1, *(stop for stop in stops if stop is not None)])


def _first_missing(numbers: DataFrame, run: int) -> int:
    """The least number from 0 that is not among the distinct ``numbers``."""
    levels = [numbers]
    while levels[-1].count() > run:
        full = levels[-1].groupBy(F.floor(F.col("number") / run).cast("bigint").alias("number")).agg(F.count("*").alias("rows"))
        levels.append(full.filter(F.col("rows") == run).select("number"))
    missing = 0
    for level, present in enumerate(reversed(levels)):
        if level > 0:
            # All runs before this one are full.
            present = present.filter((F.col("number") >= missing * run) & (F.col("number") < (missing + 1) * run))
            missing *= run
        held = {row.number for row in present.collect()}
        while missing in held:
            missing += 1
    return missing


class IncompleteLanding(ValueError):
    """Fewer pages or records landed than the pages themselves state."""


def require_complete(report: Row) -> None:
    """Raise if the report of ``page_completeness`` lacks pages or records, or states that there are none."""
    if not report.records_expected or report.pages_missing > 0 or report.records_missing > 0:
        raise IncompleteLanding(f"the landed pages are not complete: {report.asDict()}")


def page_completeness(pages: DataFrame, doc: str = "doc", path: tuple[str, ...] = RECORD_LIST) -> DataFrame:
    """Landed pages and records against the totals that the pages themselves state."""
    parsed = pages.select(F.from_json(F.col(doc), f"{_list_schema(path)}, {PAGE_TOTALS}").alias("_doc"))
    records = F.size(_record_list(F.col("_doc"), path))
    landed = parsed.select(F.col("_doc.page").alias("page"), F.coalesce(records, F.lit(0)).alias("records"))
    return landed.agg(
        F.countDistinct("page.number").alias("pages_seen"),
        F.coalesce(F.max("page.totalPages"), F.lit(0)).alias("pages_expected"),
        F.coalesce(F.sum("records"), F.lit(0)).alias("records_seen"),
        F.coalesce(F.max("page.totalElements"), F.lit(0)).alias("records_expected"),
    ).select(
        "*",
        (F.col("pages_expected") - F.col("pages_seen")).alias("pages_missing"),
        (F.col("records_expected") - F.col("records_seen")).alias("records_missing"),
    )
