"""Run a job: spark-submit --py-files … jobs.py {load,check,orders,items,all,clean} --root ROOT [--feed FEED]"""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from delivery_marts.plans import pipeline
from delivery_marts.sinks.retention import remove_old

JOBS = {
    "load": lambda spark, args: pipeline.load(spark, args.feed, args.root, resume=args.resume),
    "check": lambda spark, args: pipeline.check_quality(spark, args.root),
    "orders": lambda spark, args: pipeline.build_orders_mart(spark, args.root, args.declared),
    "items": lambda spark, args: pipeline.build_items_mart(spark, args.root, args.declared),
    "all": lambda spark, args: pipeline.run_pipeline(spark, args.feed, args.root),
    "clean": lambda spark, args: remove_old(spark, args.root, args.keep, dt.timedelta(days=args.days)),
}


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("job", choices=JOBS)
    parser.add_argument("--root", required=True, help="folder of the published tables and marts")
    parser.add_argument("--feed", help="glob of the raw parquet files (load, all)")
    parser.add_argument("--declared", action="store_true", help="marts in declared types (orders, items)")
    parser.add_argument("--resume", action="store_true", help="go on with a load that broke off (load)")
    parser.add_argument("--keep", type=int, default=1, help="newest versions that stay (clean)")
    parser.add_argument("--days", type=float, default=1, help="younger versions stay as well (clean)")
    args = parser.parse_args(argv)
    if args.job in ("load", "all") and not args.feed:
        parser.error(f"{args.job} needs --feed")
    return args


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = SparkSession.builder.appName(f"delivery-marts-{args.job}").getOrCreate()
    print(JOBS[args.job](spark, args))


if __name__ == "__main__":
    main()
