"""Time the four jobs and the main plans; prints one JSON line.

BENCH_SF_DIR  tables to read             (default /root/testdata/sf0.1)
BENCH_CPUS    cores of the local session (default 8)
BENCH_NAIVE   set to also time the marts in their naive form
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from delivery_marts.operators.quality import quality_report  # noqa: E402
from delivery_marts.plans import pipeline  # noqa: E402
from delivery_marts.plans.marts import items_mart, orders_mart  # noqa: E402
from delivery_marts.plans.normalize import normalize  # noqa: E402
from delivery_marts.schemas import RAW_FEED  # noqa: E402
from delivery_marts.sources import driver_tables  # noqa: E402
from delivery_marts.sources.raw_feed import read_feed  # noqa: E402
from delivery_marts.sources.tables import read_current  # noqa: E402


def write_clean_feed(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The mapped feed as three parquet files, without the faults that stop a load."""
    feed = driver_tables.read_feed(spark, sf_dir).withColumns(
        {
            "user_phone": F.concat(F.lit("8 (900) "), F.lpad(F.col("user_id").cast("string"), 7, "0")),
            "item_replaced_id": F.col("item_replaced_id") % 50,
        }
    )
    ordered = feed.repartition(3, "file_no").sortWithinPartitions("row_no")
    ordered.select(*RAW_FEED.names).write.parquet(path)


def run(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def naive_orders_mart(t: dict[str, DataFrame]) -> DataFrame:
    """Every line joined to its whole order, then grouped by the order's columns."""
    rate = F.expr("item_price * (1 - item_discount / 100) * (1 - order_discount / 100)")
    drivers = t["delivery_assignments"].where("unassigned_at IS NULL").groupBy("order_id")
    rows = t["orders"].join(t["order_items"], "order_id", "left")
    return (
        rows.join(drivers.agg(F.max("driver_id").alias("driver_id")), "order_id", "left")
        .groupBy(*t["orders"].columns, "driver_id")
        .agg(
            F.sum(F.col("item_quantity") * rate),
            F.sum(F.expr("item_quantity - item_canceled_quantity") * rate),
        )
    )


def naive_items_mart(t: dict[str, DataFrame]) -> DataFrame:
    """Lines joined to orders and items, then one grouping with two distinct counts."""
    rows = t["orders"].join(t["order_items"], "order_id", "left").join(t["items"], "item_id", "left")
    cells = rows.groupBy(
        F.to_date("created_at"), F.substring_index("address_text", ",", 1), "store_id", *t["items"].columns
    )
    return cells.agg(
        F.sum(F.expr("item_quantity * item_price * (1 - item_discount / 100)")),
        F.sum("item_quantity"),
        F.sum("item_canceled_quantity"),
        F.count_distinct("order_id"),
        F.expr("count(DISTINCT order_id) FILTER (WHERE item_canceled_quantity > 0)"),
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("delivery-marts-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    work = tempfile.mkdtemp(prefix="delivery-marts-bench-")
    raw, root = f"{work}/raw", f"{work}/published"
    seconds: dict[str, float] = {}

    def timed(name: str, job: Callable[[], object]) -> None:
        start = time.perf_counter()
        job()
        seconds[name] = round(time.perf_counter() - start, 3)

    start = time.perf_counter()
    write_clean_feed(spark, sf_dir, raw)
    setup = round(time.perf_counter() - start, 3)

    # One whole run first: it pays for class loading and code generation, and is reported
    # by itself.
    start = time.perf_counter()
    pipeline.run_pipeline(spark, raw, f"{work}/first-run")
    first_run = round(time.perf_counter() - start, 3)

    # The jobs as they are run, writes included.
    timed("load_tables", lambda: pipeline.load(spark, raw, root))
    timed("quality_checks", lambda: pipeline.check_quality(spark, root))
    timed("orders_datamart", lambda: pipeline.build_orders_mart(spark, root))
    timed("items_datamart", lambda: pipeline.build_items_mart(spark, root))

    # The plans alone.
    for name, table in normalize(read_feed(spark, raw)).items():
        timed(f"normalize_{name}", lambda table=table: run(table))
    t = read_current(spark, root)
    timed("quality_report", lambda: run(quality_report(t)))
    timed("orders_mart", lambda: run(orders_mart(t["orders"], t["order_items"], t["delivery_assignments"])))
    timed("items_mart", lambda: run(items_mart(t["orders"], t["order_items"], t["items"])))

    result = {
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
        "setup_sec": setup,
        "first_run_sec": first_run,
    }
    if os.environ.get("BENCH_NAIVE"):
        seconds = {}
        timed("orders_mart", lambda: run(naive_orders_mart(t)))
        timed("items_mart", lambda: run(naive_items_mart(t)))
        result["naive"] = seconds
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
