"""Time the five file-to-file stages on scaled-up CSV input.

    python bench_stages.py DATA_DIR WORK_DIR [--copies 200] [--order-copies 7] [--cpus 4]

Writes the raw CSV files under WORK_DIR once, then runs the stages over them and prints one
JSON line. With the defaults and the 0.1 tables that is 20 million events.
"""

from __future__ import annotations

import argparse
import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from clickline.operators.scale import scale_up  # noqa: E402
from clickline.plans import end_to_end  # noqa: E402
from clickline.sources import files, testtables  # noqa: E402


def main() -> None:
    parser = argparse.ArgumentParser()
    parser.add_argument("data_dir")
    parser.add_argument("work_dir")
    parser.add_argument("--copies", type=int, default=200)
    parser.add_argument("--order-copies", type=int, default=7)
    parser.add_argument("--cpus", default="4")
    parser.add_argument("--hot", action="store_true", help="give a third of all events and orders to one user")
    parser.add_argument("--event-log", help="directory for Spark's event log")
    args = parser.parse_args()

    builder = (
        SparkSession.builder.master(f"local[{args.cpus}]")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(4 * int(args.cpus)))
    )
    if args.event_log:
        builder = builder.config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", args.event_log)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")

    kind = "hot" if args.hot else "even"
    raw_dir = Path(args.work_dir) / f"raw_{kind}_{args.copies}"

    def source(name: str, copies: int):
        frame = scale_up(getattr(testtables, f"raw_{name}")(spark, args.data_dir).repartition(64), copies)
        if args.hot:
            third = F.col("customer_id").isNotNull() & (F.pmod(F.xxhash64(*frame.columns), F.lit(3)) == 0)
            frame = frame.withColumn("customer_id", F.when(third, "hot").otherwise(F.col("customer_id")))
        return frame

    if not raw_dir.exists():
        files.write_csv(source("events", args.copies), f"{raw_dir}/events", 32)
        files.write_csv(source("transactions", args.order_copies), f"{raw_dir}/transactions", 8)
        files.write_csv(testtables.raw_products(spark, args.data_dir), f"{raw_dir}/products")

    out = Path(args.work_dir) / f"out_{int(time.time())}"
    run = end_to_end.Run(*[f"{raw_dir}/{name}" for name in ("events", "transactions", "products")], str(out))
    timings: dict[str, float] = {}
    for stage, compute in end_to_end.ALL_STAGES.items():
        started = time.perf_counter()
        compute(spark, run)
        timings[stage] = round(time.perf_counter() - started, 2)
    rows = spark.read.parquet(f"{out}/output/events_with_sessions").count()
    orders = spark.read.parquet(f"{out}/output/attributed_orders").count()
    spark.stop()
    print(json.dumps({"stages": timings, "total": round(sum(timings.values()), 2), "events": rows,
                      "orders": orders, "cpus": args.cpus, "input": kind}))


if __name__ == "__main__":
    main()
