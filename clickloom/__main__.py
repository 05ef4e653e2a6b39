"""Command line of the pipeline, for ``spark-submit`` or ``python -m clickloom``.

    run      ingest months and update all tables     --source --landing [--months YYYY-MM ...] [--one-by-one]
    stream   take in the files that are new          --source --state
    rebuild  build all tables from the history again
    check    run the checks; ends with status 1 if one fails
    report   top-products, funnel, sales-by-hour or sales-by-weekday
"""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from clickloom.plans import pipeline, reports
from clickloom.session import cluster_conf
from clickloom.sources.tables import Warehouse
from clickloom.streaming.new_files import process_new_files

#: Jobs ask for shuffle partitions by their own data; a session starts with as many as this part of a slice needs.
SLICES_IN_FLIGHT = 64

#: The reports read the daily sums and the sessions' first times, which are brought up to date first.
REPORTS = {
    "top-products": lambda w: reports.top_products_of_days(w.read("daily_products"), w.read("dim_products")),
    "funnel": lambda w: reports.funnel_of_sessions(w.read("session_state")),
    "sales-by-hour": lambda w: reports.sales_of_hours(
        w.read("daily_hours"), w.read("dim_datetime"), *reports.HOUR
    ).orderBy(*reports.HOUR),
    "sales-by-weekday": lambda w: reports.sales_of_hours(
        w.read("daily_hours"), w.read("dim_datetime"), *reports.WEEKDAY
    ).orderBy(*reports.WEEKDAY),
}


def parse(arguments: Sequence[str]) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="clickloom", description="E-commerce clickstream pipeline")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("run", "stream", "rebuild", "check", "report"):
        command = commands.add_parser(name)
        command.add_argument("--warehouse", required=True, help="root folder of the tables")
        if name in ("run", "stream"):
            command.add_argument("--source", required=True, help="folder of the CSV batches")
            command.add_argument("--lookback-days", type=int, help="merge late events of so many days")
        if name == "run":
            command.add_argument("--landing", required=True, help="folder of the landed months")
            command.add_argument("--months", nargs="+", help="YYYY-MM; by default all that are new")
            command.add_argument("--one-by-one", action="store_true", help="one month after the other")
        if name == "stream":
            command.add_argument("--state", required=True, help="folder that remembers the files seen")
            command.add_argument("--max-files", type=int, default=1000, help="files per batch")
        if name in ("run", "stream", "rebuild"):
            command.add_argument("--publish", metavar="DATABASE", help="declare the tables in the catalog")
        if name == "report":
            command.add_argument("name", choices=sorted(REPORTS))
    return parser.parse_args(arguments)


def passed(checks: DataFrame) -> bool:
    """Print the checks that fail (there are 27 at most)."""
    failing = checks.where("failures > 0").orderBy("table_name", "column_name", "check_name").collect()
    for row in failing:
        print(f"{row.check_name}({row.table_name}.{row.column_name}): {row.failures} failures")
    return not failing


def main(arguments: Sequence[str]) -> int:
    options = parse(arguments)
    builder = SparkSession.builder.appName("clickloom")
    if SparkSession.getActiveSession() is None:  # the settings of a session that is there are its owner's
        builder = builder.config(map=cluster_conf(pipeline.SLICE_BYTES // SLICES_IN_FLIGHT))
    spark = builder.getOrCreate()
    warehouse = Warehouse(spark, options.warehouse)
    if options.command == "report":
        pipeline.update_summaries(warehouse)
        REPORTS[options.name](warehouse).show(100, truncate=False)
        return 0
    if options.command == "run":
        pipeline.run_pipeline(
            warehouse, options.source, options.landing, options.months, options.one_by_one, options.lookback_days
        )
    elif options.command == "stream":
        process_new_files(
            warehouse,
            options.source,
            options.state,
            max_files=options.max_files,
            lookback_days=options.lookback_days,
        )
    elif options.command == "rebuild":
        pipeline.transform(warehouse, full_refresh=True)
    if options.command != "check" and options.publish:
        warehouse.publish(options.publish)
    return 0 if passed(pipeline.check(warehouse)) else 1


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
