"""Run the job: ``spark-submit -m salesloom`` or ``python -m salesloom``.

Steps run in one session, in the order load, snapshot, build. To run them apart, give the
session a catalog that outlives it.
"""

from __future__ import annotations

import argparse
from datetime import datetime, timezone

from pyspark.sql import SparkSession

from salesloom.functions import clean
from salesloom.operators.staging import clear_staged
from salesloom.plans.build import Options, build_tables, snapshot_deals
from salesloom.sources.load import crm_sources, report_totals, run_sources, sheet_sources

STEPS = ("load", "snapshot", "build")


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="salesloom", description=__doc__)
    parser.add_argument("--steps", nargs="+", choices=STEPS, default=list(STEPS))
    parser.add_argument("--crm", help="folder of the API dumps, <table>_response.json each")
    parser.add_argument("--sheets", help="folder of the exported sheets, <sheet>.csv each")
    parser.add_argument("--lake", help="folder of the raw zone and the deal history")
    parser.add_argument("--lines", action="store_true", help="dumps hold one document per line")
    parser.add_argument(
        "--no-line-breaks", action="store_true", help="no cell of a sheet holds a line break"
    )
    parser.add_argument("--normalize-names", action="store_true", help="goals meet accented names")
    parser.add_argument("--include-goal-only", action="store_true", help="sellers of goals alone")
    parser.add_argument("--group-casefold", action="store_true", help="channels whatever their case")
    parser.add_argument("--day-mode", choices=("elapsed", "calendar"), default="elapsed")
    parser.add_argument("--lasting-keys", action="store_true", help="sellers keep their keys from build to build")
    parser.add_argument("--changed-only", action="store_true", help="write only months with other rows")
    parser.add_argument("--money-text", action="store_true", help="plain amounts may be money text")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="moment of the run")
    options = parser.parse_args(arguments)
    if not options.lake and (set(options.steps) != {"build"} or options.lasting_keys):
        parser.error("load, snapshot and lasting keys need --lake")

    spark = (
        SparkSession.builder.appName("salesloom")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    run_time = options.as_of or datetime.now(timezone.utc)
    try:
        return _run(spark, options, run_time)
    finally:
        clear_staged(spark)


def _run(spark: SparkSession, options: argparse.Namespace, run_time: datetime) -> int:
    failed = False
    if "load" in options.steps:
        sources = crm_sources(options.crm, options.lines) if options.crm else []
        sources += sheet_sources(options.sheets, not options.no_line_breaks) if options.sheets else []
        report = run_sources(spark, sources, options.lake, run_time)
        report.show(truncate=False)
        failed = report_totals(report)["error"] > 0
    if "snapshot" in options.steps:
        snapshot_deals(spark, f"{options.lake}/snapshots/crm_deals", run_time)
    if "build" in options.steps:
        repaired = Options(
            normalize_names=options.normalize_names,
            include_goal_only=options.include_goal_only,
            group_casefold=options.group_casefold,
            day_mode=options.day_mode,
            key_registry=f"{options.lake}/keys/sellers" if options.lasting_keys else None,
            changed_only=options.changed_only,
            money=clean.parse_money if options.money_text else clean.safe_numeric,
        )
        build_tables(spark, run_time, repaired)
    return int(failed)


if __name__ == "__main__":
    raise SystemExit(main())
