"""The loads as jobs: ``spark-submit lakezones/jobs.py <job> ...`` with the package on the path.

Each job builds its session from the submit configuration, which also names the catalog, the
Iceberg or Delta extensions where there are any, and ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Sequence
from datetime import date, datetime, timezone

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from lakezones.fixed_values import BACKFILL_END, BACKFILL_START, ORDER_TIMESTAMP_COLUMNS
from lakezones.operators.windows import worklist
from lakezones.plans.backfill import backfill_orders, load_backfill, load_backfills
from lakezones.plans.curated import load_curated
from lakezones.plans.raw_customers import KEY, load_raw_customers, raw_records
from lakezones.plans.refined_customers import load_refined_customers
from lakezones.plans.runner import run_tables
from lakezones.session import prepare_session
from lakezones.sources.delimited import read_text_csv
from lakezones.sources.pages import page_completeness, pages_until_end, read_pages, require_complete
from lakezones.specs import TableSpec
from lakezones.streaming.upserts import upsert_new_files
from lakezones.streaming.watermark import WatermarkStore

log = logging.getLogger(__name__)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="lakezones.jobs")
    top.add_argument("--shuffle-gb", type=int, default=2048, help="about the size of the table that is sorted or merged")
    jobs = top.add_subparsers(dest="job", required=True)

    job = jobs.add_parser("source-to-raw", help="merge landed pages into the raw customer table")
    job.add_argument("--landing", required=True, help="page documents, one per line")
    job.add_argument("--whole-files", action="store_true", help="one page document per file")
    job.add_argument("--table", required=True)
    job.add_argument("--state", required=True, help="folder of the watermark")
    job.add_argument("--full", action="store_true", help="read everything, whatever the watermark")
    job.add_argument("--require-complete", action="store_true", help="fail if pages or records are missing")
    job.add_argument("--until-end", action="store_true", help="leave out pages beyond the first gap, empty or last page")
    job.add_argument("--provider", default="parquet")

    job = jobs.add_parser("stream-customers", help="merge newly landed pages into a table of the latest records")
    job.add_argument("--landing", required=True, help="page documents, one per line")
    job.add_argument("--table", required=True)
    job.add_argument("--checkpoint", required=True)
    job.add_argument("--max-files", type=int, help="files of one batch; the result does not depend on it")
    job.add_argument("--provider", default="parquet")

    job = jobs.add_parser("raw-to-refined", help="rebuild refined customer tables")
    job.add_argument("--raw-table", action="append", required=True, help="may be repeated")
    job.add_argument("--refined-table", action="append", required=True, help="one for each raw table")
    job.add_argument("--provider", default="parquet")

    job = jobs.add_parser("refined-to-curated", help="merge the latest ingest day")
    job.add_argument("--refined-database", required=True)
    job.add_argument("--curated-database", required=True)
    job.add_argument("--table", action="append", required=True, metavar="NAME:KEY[,KEY]", help="may be repeated")
    job.add_argument("--ingest-column", default="ingest_timestamp")
    job.add_argument("--provider", default="parquet")

    job = jobs.add_parser("backfill", help="append landed order extracts to the raw order table")
    job.add_argument("--source", action="append", required=True, help="extracts of one center, may be repeated")
    job.add_argument("--table", required=True)
    job.add_argument("--run-day", type=date.fromisoformat, default=None)
    job.add_argument("--timestamp-column", action="append", help="default: the order timestamps")
    job.add_argument("--ship-date-column")
    job.add_argument("--shipdate-from", type=date.fromisoformat)
    job.add_argument("--shipdate-to", type=date.fromisoformat)
    job.add_argument("--replace", action="store_true", help="replace the rows of an earlier run of the day")
    job.add_argument("--single-line", action="store_true", help="no line breaks inside quotes: large files are split")
    job.add_argument("--rejects-table", help="takes the rows that do not fit the header of their extract")
    job.add_argument("--most-rejects", type=int, help="fail before anything is written if more rows do not fit")
    job.add_argument("--provider", default="parquet")

    job = jobs.add_parser("backfill-tables", help="the backfill of several tables")
    job.add_argument("--tables", required=True, help="JSON: a list of {name, sources, timestamp_columns}")
    job.add_argument("--database", required=True)
    job.add_argument("--run-day", type=date.fromisoformat, default=None)
    job.add_argument("--replace", action="store_true", help="replace the rows of an earlier run of the day")
    job.add_argument("--single-line", action="store_true", help="no line breaks inside quotes: large files are split")
    job.add_argument("--most-rejects", type=int, help="fail before anything is written if more rows do not fit")
    job.add_argument("--provider", default="parquet")

    job = jobs.add_parser("worklist", help="write the extracts of a backfill, one row per center and window")
    job.add_argument("--centers", required=True, help="CSV with a header, one center per row")
    job.add_argument("--output", required=True)
    job.add_argument("--start", type=date.fromisoformat, default=date.fromisoformat(BACKFILL_START))
    job.add_argument("--end", type=date.fromisoformat, default=date.fromisoformat(BACKFILL_END))
    job.add_argument("--clamp", action="store_true", help="cut the last window at the end")
    return top


def table_spec(text: str) -> TableSpec:
    name, _, keys = text.partition(":")
    if not name or not keys:
        raise ValueError(f"expected NAME:KEY[,KEY], got {text!r}")
    return TableSpec(name, primary_keys=tuple(keys.split(",")))


def table_specs(spark: SparkSession, path: str) -> list[TableSpec]:
    """The table configurations of a JSON file."""
    entries = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return [
        TableSpec(entry["name"], (), tuple(entry.get("timestamp_columns", ())), tuple(entry["sources"])) for entry in entries
    ]


def run(spark: SparkSession, arguments: Sequence[str] | None = None) -> None:
    args = parser().parse_args(arguments)
    now = datetime.now(timezone.utc)
    if args.job == "source-to-raw":
        pages = read_pages(spark, args.landing, args.whole_files)
        if args.until_end:
            pages = pages_until_end(pages)
        report = page_completeness(pages).first()
        log.info("pages: %s", report.asDict())
        if args.require_complete:
            require_complete(report)
        state = WatermarkStore(spark, args.state)
        log.info("%s", load_raw_customers(pages, args.table, state, now, provider=args.provider, full=args.full))
    elif args.job == "raw-to-refined":
        if len(args.raw_table) != len(args.refined_table):
            raise ValueError("one refined table is needed for each raw table")
        run_tables(
            [TableSpec(refined, sources=(raw,)) for raw, refined in zip(args.raw_table, args.refined_table)],
            lambda spec: load_refined_customers(spark, spec.sources[0], spec.name, args.provider),
        )
    elif args.job == "stream-customers":
        upsert_new_files(
            spark, args.landing, "doc string", lambda pages: raw_records(pages, now), args.table, [KEY], "updated",
            args.checkpoint, ties=["Content"], times=["updated"], max_files=args.max_files, provider=args.provider,
        ).awaitTermination()
    elif args.job == "refined-to-curated":
        run_tables(
            map(table_spec, args.table),
            lambda spec: load_curated(
                spark, spec, args.refined_database, args.curated_database, args.ingest_column, args.provider
            ),
        )
    elif args.job == "backfill":
        orders = backfill_orders(
            spark, args.source, args.run_day or now.date(), args.timestamp_column or ORDER_TIMESTAMP_COLUMNS,
            args.ship_date_column, args.shipdate_from, args.shipdate_to, multi_line=not args.single_line, rejects=True,
        )
        load_backfill(orders, args.table, args.replace, args.provider, args.rejects_table, args.most_rejects)
    elif args.job == "backfill-tables":
        load_backfills(
            spark, table_specs(spark, args.tables), args.database, args.run_day or now.date(), args.replace,
            args.provider, multi_line=not args.single_line, most_rejects=args.most_rejects,
        )
    else:
        centers = read_text_csv(spark, args.centers)
        worklist(centers, F.lit(args.start), F.lit(args.end), clamp=args.clamp).write.json(args.output)


def main() -> None:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = SparkSession.builder.appName("lakezones").getOrCreate()
    local = spark.conf.get("spark.master", "").startswith("local")
    prepare_session(spark, None if local else parser().parse_args().shuffle_gb << 30)
    run(spark)


if __name__ == "__main__":
    main()
