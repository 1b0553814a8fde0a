"""Run the operators on rows of which a third share one key; print how evenly the tasks were loaded.

Usage: python tests/skew_check.py <new folder>
"""

from __future__ import annotations

import json
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import functions as F  # noqa: E402

from lakemart.operators import dedupe, ranking  # noqa: E402
from lakemart.plans import gold  # noqa: E402
from lakemart.session import build_session, stored  # noqa: E402

ROWS, ORDERS, PRODUCTS = 12_000_000, 4_000_000, 400_000


def tables(spark):
    hot = F.when(F.col("id") % 3 == 0, "7").otherwise((F.hash("id") % PRODUCTS).cast("string"))
    items = spark.range(0, ROWS, 1, 48).select(
        (F.col("id") % ORDERS).cast("string").alias("order_id"),
        F.concat_ws("_", F.col("id") % ORDERS, "id").alias("order_item_key"),
        hot.alias("product_id"),
        (F.col("id") % 10_000).cast("decimal(12,2)").alias("price"),
        F.lit(1).cast("decimal(12,2)").alias("freight_value"),
    )
    products = spark.range(0, PRODUCTS, 1, 8).select(
        F.col("id").cast("string").alias("product_id"),
        F.concat(F.lit("c"), F.col("id") % 70).alias("product_category_name"),
        F.lit(None).cast("string").alias("product_category_name_english"),
    )
    day = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("id") % 600).cast("int"))
    orders = spark.range(0, ORDERS, 1, 16).select(
        F.col("id").cast("string").alias("order_id"), day.alias("order_purchase_date")
    )
    return stored(items, "items"), stored(products, "products"), stored(orders, "orders")


def main(folder: str) -> None:
    events = Path(folder) / "events"
    events.mkdir(parents=True)
    spark = build_session(
        "skew",
        master="local[8]",
        conf={
            "spark.sql.shuffle.partitions": "64",
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": f"{folder}/shared",
            "spark.eventLog.enabled": "true",
            "spark.eventLog.compress": "false",
            "spark.eventLog.dir": str(events),
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.files.maxPartitionBytes": "8m",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    items, products, orders = tables(spark)
    third = F.hash("order_item_key") % 3 == 0
    runs = {
        "category mart, hot product": lambda: gold.category_sales(items, products, orders),
        "category mart again": lambda: gold.category_sales(items, products, orders),
        "latest per key, hot key": lambda: dedupe.latest_per_key(
            items.withColumn("k", F.when(third, "hot").otherwise(F.col("order_id"))), "k", "price"
        ),
        "equal rows, a third copies": lambda: dedupe.number_equal_rows(
            items.select(F.when(third, "hot").otherwise(F.col("order_item_key")).alias("a")), "n"
        ),
        "global rank, a third tied": lambda: ranking.global_row_number(
            items.select("order_item_key", F.when(third, 0).otherwise(F.hash("order_id")).alias("v")),
            [F.desc("v"), F.asc("order_item_key")],
        ),
    }
    spans = []
    for name, make in runs.items():
        start = time.time()
        make().write.format("noop").mode("overwrite").save()
        spans.append((name, start, time.time()))
    spark.stop()

    tasks: dict[int, list[tuple[float, float, int]]] = {}
    for file in events.rglob("*"):
        for line in file.read_text().splitlines() if file.is_file() else ():
            if line.startswith('{"Event":"SparkListenerTaskEnd"'):
                event = json.loads(line)
                info, metrics = event["Task Info"], event.get("Task Metrics", {})
                read = metrics.get("Shuffle Read Metrics", {}).get("Total Records Read", 0)
                tasks.setdefault(event["Stage ID"], []).append(
                    (info["Launch Time"] / 1e3, info["Finish Time"] / 1e3, read)
                )
    for name, start, end in spans:
        print(f"{name}: {end - start:.1f} s")
        for stage, done in sorted(tasks.items()):
            if start - 0.05 <= min(t[0] for t in done) and max(t[1] for t in done) <= end + 0.05:
                read = sorted(t[2] for t in done)
                if read[-1] > ROWS // 100:
                    print(f"  stage {stage}: {len(read)} tasks, rows read median {read[len(read) // 2]}, most {read[-1]}")


if __name__ == "__main__":
    main(sys.argv[1])
