"""Command line of the daily job, for ``spark-submit``.

    run [--date D]                     load one day, yesterday in Tokyo when left out
    run-range --start-date D [--end-date D]
    reprocess --date YYYY-MM-DD
    run-late --index PATH              load again the days that new files of the log bring plays for
    import-signage --sheet PATH --table T    copy a CSV sheet to a signage table

With ``--max-rejects N`` a text log is landed as Parquet first, and up to N broken records in it are put aside;
what they are is printed to standard error. Without, a broken record fails the load.

Prints the run log as JSON lines and the summary after it. Exits with 0 when every day succeeded,
2 when only some did, 1 otherwise.
"""

import argparse
import sys

from pyspark.sql import DataFrame, SparkSession

from hourboard.functions import times
from hourboard.jobs import ArgumentError, ImpressionJob, run_summary
from hourboard.scratch import scratch_path
from hourboard.sinks.environments import get_environment
from hourboard.sinks.versions import VersionedStore
from hourboard.sources.arrivals import ArrivalIndex
from hourboard.sources.readers import (
    import_signage,
    land_requests,
    read_requests,
    read_signage,
    read_signage_csv,
    reject_counts,
)


def parser() -> argparse.ArgumentParser:
    common = argparse.ArgumentParser(add_help=False)
    common.add_argument("--requests", required=True, help="request log: table, or path")
    common.add_argument("--requests-format", help="file format, when --requests is a path")
    common.add_argument("--log-date", help="UTC date column the log is partitioned by")
    common.add_argument("--max-rejects", type=int, help="broken records of a text log to put aside at most")
    common.add_argument("--landing", help="new folder for the landed log, instead of one in the scratch folder")
    common.add_argument("--signage", required=True, help="signage: table, or path of a sheet")
    common.add_argument("--signage-format", choices=("table", "csv"), default="table")
    common.add_argument("--environment", help="development, staging or production")
    common.add_argument("--database", help="database of the target, instead of the environment's")
    common.add_argument("--zone", default=times.TOKYO, help="time zone of days and opening hours")
    common.add_argument("--store", help="folder of a target kept in versions, instead of a table")
    common.add_argument("--catalog", help="catalog of the target table")
    common.add_argument("--table", help="target table, instead of the environment's")

    top = argparse.ArgumentParser(prog="hourboard", description="Load hourly impressions.")
    commands = top.add_subparsers(dest="command", required=True)
    commands.add_parser("run", parents=[common]).add_argument("--date")
    commands.add_parser("reprocess", parents=[common]).add_argument("--date")
    span = commands.add_parser("run-range", parents=[common])
    span.add_argument("--start-date")
    span.add_argument("--end-date")
    late = commands.add_parser("run-late", parents=[common])
    late.add_argument("--index", required=True, help="folder of the index of files that have arrived")
    sheet = commands.add_parser("import-signage")
    sheet.add_argument("--sheet", required=True, help="path of a CSV sheet")
    sheet.add_argument("--table", required=True, help="signage table to replace")
    return top


def _requests(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.max_rejects is None:
        return read_requests(spark, args.requests, args.requests_format, args.log_date)
    place = args.landing or scratch_path(spark, "landed")
    landed = land_requests(spark, args.requests, args.requests_format, place, args.log_date, args.max_rejects)
    if landed.rejected:
        for line in reject_counts(landed.rejects).orderBy("reason").toJSON().collect():  # one row a reason
            print(line, file=sys.stderr)
    return landed.requests


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("hourboard").getOrCreate()
    if args.command == "import-signage":
        import_signage(spark, args.sheet, args.table)
        return 0
    try:
        environment = get_environment(args.environment, args.catalog, args.database)
        is_sheet = args.signage_format == "csv"
        requests = _requests(spark, args)
        job = ImpressionJob(
            spark,
            requests,
            (read_signage_csv if is_sheet else read_signage)(spark, args.signage),
            environment.qualify(args.table) if args.table else environment.target,
            options={"zone": args.zone} | ({"log_date": args.log_date} if args.log_date else {}),
            store=VersionedStore(spark, args.store, requests.schema["timestamp"].dataType) if args.store else None,
        )
        if args.command == "run-range":
            log = job.run_range(args.start_date, args.end_date)
        elif args.command == "run-late":
            index = ArrivalIndex(spark, args.index, args.zone)
            index.update(args.requests, args.requests_format)
            log = job.run_late(index)
        else:
            log = (job.run if args.command == "run" else job.reprocess)(args.date)
    except (ArgumentError, ValueError) as error:
        print(error, file=sys.stderr)
        return 1
    outcome = run_summary(log)
    for line in log.orderBy("process_date").toJSON().collect() + outcome.toJSON().collect():
        print(line)
    successes = [row["success"] for row in log.select("success").collect()]
    return 0 if all(successes) else 2 if any(successes) else 1


if __name__ == "__main__":
    sys.exit(main())
