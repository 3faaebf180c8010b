"""The load job: every source into its staging table, with a report of what happened."""

from __future__ import annotations

import logging
from collections.abc import Callable, Iterable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import partial
from threading import Event

from py4j.protocol import Py4JJavaError
from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession

from salesloom.functions.names import rename_columns, table_name
from salesloom.operators.shape import drop_blank_rows
from salesloom.sources import schemas
from salesloom.sources.readers import read_api_envelope, read_grid, stamp, stringify_all
from salesloom.sources.tables import ensure_database, land, replace_table

STAGING = "staging"
# Sources that are loaded at the same time.
CONCURRENT = 8
REPORT = "source string, table string, status string, rows bigint, error string"

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class ApiSource:
    """API dumps of one entity: ``path`` is a file, folder or pattern."""

    path: str
    table: str
    entity: str
    schema: str | None = None
    lines: bool = False


@dataclass(frozen=True)
class GridSource:
    """Exported tabs of one spreadsheet: pairs of (tab, path)."""

    sheet: str
    tabs: tuple[tuple[str, str], ...]
    multi_line: bool = True


def crm_sources(folder: str, lines: bool = False) -> list[ApiSource]:
    """The four API entities, as ``<table>_response.json`` files or folders of pages."""
    return [
        ApiSource(f"{folder}/{table}_response.json", table, entity, schema, lines)
        for table, entity, schema in schemas.CRM_TABLES
    ]


def sheet_sources(folder: str, multi_line: bool = True) -> list[GridSource]:
    """The four spreadsheets, each exported as ``<sheet>.csv``."""
    return [
        GridSource(sheet, ((sheet, f"{folder}/{sheet}.csv"),), multi_line)
        for sheet in schemas.SHEET_TABLES
    ]


# An aborted job surfaces as the Java error itself.
SPARK_ERRORS = (PySparkException, Py4JJavaError)


def _missing(error: Exception) -> bool:
    return isinstance(error, AnalysisException) and error.getCondition() == "PATH_NOT_FOUND"


def _malformed(error: Exception) -> bool:
    return "MALFORMED_RECORD" in str(error)


def load_api(spark: SparkSession, source: ApiSource, raw_root: str, run_time: datetime) -> tuple:
    """One entity: read, stamp, land in the raw zone, load the landed rows into staging.

    The dump is parsed once, by the landing. An absent, empty or malformed dump is skipped; raw
    zone and table keep what they hold. Failures of the landing or the load stop the job.
    """
    try:
        records = read_api_envelope(spark, source.path, source.schema, source.lines)
        stamped = stamp(records, run_time)
        landed = land(stamped, raw_root, source.entity, run_time.date(), keep_if_empty=True)
        if landed is None:
            return (source.path, source.table, "skipped", None, "no records")
    except SPARK_ERRORS as error:
        if _missing(error):
            return (source.path, source.table, "skipped", None, "not found")
        if _malformed(error):
            return (source.path, source.table, "skipped", None, "malformed JSON")
        raise
    rows = replace_table(spark.read.schema(stamped.schema).json(landed), STAGING, source.table)
    return (source.path, source.table, "success", rows, None)


def load_tab(
    spark: SparkSession, sheet: str, tab: str, path: str, run_time: datetime, multi_line: bool
) -> tuple:
    """One tab: read, drop blank rows, stamp, clean the names, store every column as text.

    The tab is parsed once, by the write. A tab that cannot be opened, or whose rows do not fit its
    header, is an error; one that cannot be read, or is empty, is skipped. The table then keeps its
    rows.
    """
    table = table_name(tab)
    try:
        grid = drop_blank_rows(read_grid(spark, path, multi_line=multi_line))
        if not grid.columns:
            return (sheet, table, "skipped", None, "no rows")
        texts = stringify_all(rename_columns(stamp(grid, run_time, sheet)))
        rows = replace_table(texts, STAGING, table, keep_if_empty=True)
    except Exception as error:  # a tab must not stop the others
        if isinstance(error, SPARK_ERRORS) and not _missing(error) and "USER_RAISED" not in str(error):
            return (sheet, table, "skipped", None, str(error))
        log.warning("load of %s failed: %s", tab, error)
        return (sheet, table, "error", None, str(error))
    return (sheet, table, "success", rows, None) if rows else (sheet, table, "skipped", None, "no rows")


def run_sources(
    spark: SparkSession,
    sources: Iterable[ApiSource | GridSource],
    raw_root: str,
    run_time: datetime | None = None,
    concurrent: int = CONCURRENT,
) -> DataFrame:
    """Load all sources, some at the same time; gives one row per source with its status and row count.

    The report keeps the order of the sources. Those that write the same table or entity run one
    after the other, so the last one stays, as if all did. A failure that stops the job lets the
    loads that are under way end and starts no other.
    """
    run_time = run_time or datetime.now(timezone.utc)
    ensure_database(spark, STAGING)
    loads: list[tuple[set[str], Callable[[], tuple]]] = []
    for source in sources:
        if isinstance(source, ApiSource):
            targets = {f"table {source.table.lower()}", f"entity {source.entity}"}
            loads.append((targets, partial(load_api, spark, source, raw_root, run_time)))
        else:
            for tab, path in source.tabs:
                load = partial(load_tab, spark, source.sheet, tab, path, run_time, source.multi_line)
                loads.append(({f"table {table_name(tab).lower()}"}, load))
    return spark.createDataFrame(_at_once(spark, loads, concurrent), REPORT)


def _lanes(targets: Sequence[set[str]]) -> list[list[int]]:
    """Positions of loads by lane; loads that share a target, directly or by others, share a lane."""
    lanes: list[tuple[set[str], list[int]]] = []
    for i, names in enumerate(targets):
        shared = [lane for lane in lanes if lane[0] & names]
        lanes = [lane for lane in lanes if not lane[0] & names]
        members = sorted([i, *(m for _, old in shared for m in old)])
        lanes.append((names.union(*(n for n, _ in shared)), members))
    return sorted(members for _, members in lanes)


def _at_once(spark: SparkSession, loads: Sequence[tuple[set[str], Callable]], concurrent: int) -> list[tuple]:
    """Results of all loads in their order; each lane is a thread and a pool of Spark's scheduler."""
    results: list[tuple | None] = [None] * len(loads)
    failed = Event()

    def run(lane: list[int]) -> None:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"load-{lane[0]}")
        for i in lane:
            if failed.is_set():
                return
            try:
                results[i] = loads[i][1]()
            except BaseException:
                failed.set()
                raise

    with ThreadPoolExecutor(max(1, concurrent)) as threads:
        lanes = _lanes([targets for targets, _ in loads])
        running = [threads.submit(inheritable_thread_target(spark)(run), lane) for lane in lanes]
    for lane in running:
        lane.result()
    return results


def report_totals(report: DataFrame) -> dict[str, int]:
    """Number of sources per status."""
    counted = {row["status"]: row["count"] for row in report.groupBy("status").count().collect()}
    return {status: counted.get(status, 0) for status in ("success", "error", "skipped")}
