"""Command line for spark-submit.

    spark-submit main.py run EVENTS.csv TRANSACTIONS.csv PRODUCTS.csv OUT_DIR [--stage NAME ...]
    spark-submit main.py scale-up SOURCE.csv TARGET_DIR --copies 10
    spark-submit main.py show OUT_DIR TABLE [--rows 50]
    spark-submit main.py timeline OUT_DIR USER_ID [--rows 50]

A failing stage raises and ends the run with a non-zero exit status.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from clickline.operators import report  # noqa: E402
from clickline.plans import end_to_end  # noqa: E402
from clickline.sources import files, schemas  # noqa: E402


def arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    commands = parser.add_subparsers(dest="command", required=True)

    run = commands.add_parser("run", help="run the stages over raw CSV files")
    for name in ("events_csv", "transactions_csv", "products_csv", "out_dir"):
        run.add_argument(name)
    run.add_argument("--stage", action="append", choices=list(end_to_end.ALL_STAGES), help="only these stages")
    run.add_argument("--files-per-table", type=int, help="lay per-user tables out by user into about this many files")

    scale = commands.add_parser("scale-up", help="copy a raw CSV file under new customer ids")
    scale.add_argument("source_csv")
    scale.add_argument("target_csv")
    scale.add_argument("--copies", type=int, default=10)
    scale.add_argument("--files", type=int, help="write this many files; by default as many as the size asks for")

    show = commands.add_parser("show", help="print schema, row count and first rows of a stage table")
    show.add_argument("out_dir")
    show.add_argument("table")
    show.add_argument("--rows", type=int, default=50)

    timeline = commands.add_parser("timeline", help="print one user's events with sessions, in time order")
    timeline.add_argument("out_dir")
    timeline.add_argument("user_id")
    timeline.add_argument("--rows", type=int, default=50)
    return parser.parse_args(argv)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    spark = spark or SparkSession.builder.appName("clickline").getOrCreate()
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    if args.command == "run":
        run = end_to_end.Run(
            args.events_csv, args.transactions_csv, args.products_csv, args.out_dir, args.files_per_table
        )
        for name in args.stage or end_to_end.ALL_STAGES:
            end_to_end.ALL_STAGES[name](spark, run)
            print(f"{name}: done")
    elif args.command == "scale-up":
        end_to_end.scale_up_csv(spark, args.source_csv, args.target_csv, args.copies, args.files)
    elif args.command == "timeline":
        sessions = files.read_table(spark, f"{args.out_dir}/output/events_with_sessions", schemas.EVENTS_WITH_SESSIONS)
        report.user_timeline(sessions, args.user_id).show(args.rows, truncate=False)
    else:
        table = files.read_table(spark, f"{args.out_dir}/{args.table}")
        table.printSchema()
        print(f"rows: {table.count()}")
        table.show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
