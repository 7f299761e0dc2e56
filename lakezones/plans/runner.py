"""Run one load for several tables."""

from __future__ import annotations

import logging
import threading
import time
import uuid
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from typing import TypeVar

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from lakezones.specs import TableSpec

log = logging.getLogger(__name__)
Result = TypeVar("Result")

# Seconds before the second try; each further one waits twice as long.
FIRST_WAIT = 3.0
# Seconds between two calls that cancel the jobs of a table, until its load has noticed.
CANCEL_EVERY = 1.0


class TableTimeout(TimeoutError):
    """The load of a table took longer than allowed; its jobs were cancelled."""


def run_tables(
    specs: Iterable[TableSpec],
    load: Callable[[TableSpec], Result],
    at_most: int = 1,
    retries: int = 0,
    first_wait: float = FIRST_WAIT,
    timeout: float | None = None,
    spark: SparkSession | None = None,
) -> dict[str, Result]:
    """Load each table, ``at_most`` so many at once. A failing table does not stop the others.

    Each load runs in a thread whose Spark jobs carry a tag of the table and belong to a scheduler
    pool of their own, so that with ``spark.scheduler.mode=FAIR`` a large table does not starve a
    small one. A load that fails is tried again ``retries`` times, after a wait that doubles. A try
    that takes longer than ``timeout`` seconds is given up: its jobs, and only those, are cancelled, and
    it is not repeated. All failures are raised together at the end.
    """
    specs, spark = list(specs), spark or SparkSession.getActiveSession()
    results: dict[str, Result] = {}
    failures: dict[str, Exception] = {}

    def one(numbered: tuple[int, TableSpec]) -> None:
        number, spec = numbered
        log.info("loading table %s", spec.name)
        try:
            results[spec.name] = _tried(spark, spec, load, retries, first_wait, timeout, f"table-{number % at_most}")
        except Exception as error:
            log.exception("table %s failed", spec.name)
            error.add_note(f"while loading table {spec.name}")
            failures[spec.name] = error

    if at_most == 1:
        for numbered in enumerate(specs):
            one(numbered)
    else:
        # Properties of the calling thread go along, in a copy for each table: of one that threads share, each
        # would change the tag and pool of the others.
        with ThreadPoolExecutor(at_most) as pool:
            runs = [pool.submit(inheritable_thread_target(one), numbered) for numbered in enumerate(specs)]
            for run in runs:
                run.result()
    if failures:
        ordered = [failures[spec.name] for spec in specs if spec.name in failures]
        raise ExceptionGroup(f"{len(ordered)} tables failed", ordered)
    return {spec.name: results[spec.name] for spec in specs}


def _tried(
    spark: SparkSession | None,
    spec: TableSpec,
    load: Callable[[TableSpec], Result],
    retries: int,
    first_wait: float,
    timeout: float | None,
    pool: str,
) -> Result:
    wait = first_wait
    for left in range(retries, -1, -1):
        try:
            with _tagged(spark, spec.name, pool, timeout):
                return load(spec)
        except TableTimeout:
            raise
        except Exception as error:
            if not left:
                raise
            log.warning("table %s failed, next try in %.1f s: %s", spec.name, wait, error)
            time.sleep(wait)
            wait *= 2
    raise AssertionError


@contextmanager
def _tagged(spark: SparkSession | None, name: str, pool: str, timeout: float | None) -> Iterator[None]:
    """Tag the jobs of this thread, and cancel them when the time is over."""
    if spark is None:
        yield
        return
    context, tag = spark.sparkContext, f"lakezones-{name}-{uuid.uuid4().hex}".replace(",", "_")
    done, late = threading.Event(), threading.Event()

    def watch() -> None:
        if done.wait(timeout):
            return
        late.set()
        # Again and again, as the load may be between two jobs.
        while not done.is_set():
            context.cancelJobsWithTag(tag)
            done.wait(CANCEL_EVERY)

    before = context.getLocalProperty("spark.scheduler.pool")
    context.setLocalProperty("spark.scheduler.pool", pool)
    context.addJobTag(tag)
    watcher = threading.Thread(target=watch, daemon=True) if timeout is not None else None
    try:
        if watcher:
            watcher.start()
        yield
    except Exception as error:
        if late.is_set():
            raise TableTimeout(f"{name} took longer than {timeout} s") from error
        raise
    finally:
        done.set()
        if watcher:
            watcher.join()
        context.removeJobTag(tag)
        context.setLocalProperty("spark.scheduler.pool", before)
