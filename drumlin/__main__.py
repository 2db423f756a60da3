"""``spark-submit``-able daily job.

    python -m drumlin --root hdfs:///telemetry --landing hdfs:///landing \\
        --start 2024-02-01T00:00:00 --end 2024-02-02T00:00:00 --source https://api.example.com
"""

from __future__ import annotations

import argparse
from datetime import datetime

from pyspark.sql import SparkSession

from drumlin.plans import daily_run
from drumlin.plans.refresh import Layout
from drumlin.session import configure
from drumlin.sources import pages


def arguments(argv=None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="drumlin")
    parser.add_argument("--root", required=True, help="shared folder of the tables")
    parser.add_argument("--landing", required=True, help="landed pages")
    parser.add_argument("--landing-format", choices=("files", "table"), default="files")
    parser.add_argument("--start", required=True, type=datetime.fromisoformat)
    parser.add_argument("--end", required=True, type=datetime.fromisoformat)
    parser.add_argument("--source", required=True, help="source_api of events that name none")
    parser.add_argument("--as-of", type=datetime.fromisoformat, help="default: now; without a zone it is UTC")
    parser.add_argument(
        "--gate", choices=(daily_run.AFTER, daily_run.BEFORE), default=daily_run.AFTER
    )
    parser.add_argument("--full", action="store_true", help="rebuild the marts from nothing")
    return parser.parse_args(argv)


def main(argv=None) -> None:
    args = arguments(argv)
    spark = configure(SparkSession.builder.appName("drumlin").getOrCreate())
    read = pages.read_page_files if args.landing_format == "files" else pages.read_page_table
    report = daily_run.daily_run(
        spark,
        pages.in_window(read(spark, args.landing), args.start, args.end),
        Layout(args.root),
        as_of=args.as_of,
        default_source=args.source,
        gate=args.gate,
        full=args.full,
        window=(args.start, args.end),
    )
    report.counts.show(truncate=False)
    report.results.show(50, truncate=False)


if __name__ == "__main__":
    main()
