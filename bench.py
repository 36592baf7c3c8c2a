"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8).
Every query is built and written in full to the noop sink, twice; the faster
run counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from opsflow.catalog import QUERIES  # noqa: E402

HEADLINES = [
    "tracked_lines",
    "sales_order_extract",
    "sales_orders",
    "tracked_shipments",
    "orders_without_lines",
    "ready_to_confirm",
    "completion_label",
    "package_numbers",
    "match_first",
    "match_precedence",
    "todate_counts",
    "reconcile_quantities",
    "last_unless_default",
    "expand_packed_events",
    "nest_orders",
    "package_documents",
    "order_documents",
    "metric_diff_log",
    "upsert",
    "delete_by_keys",
    "session_counts",
    "sync_stream",
    # whole documents in long form, a table in buckets, and keys hot on both sides
    "order_nodes",
    "upsert_buckets",
    "match_groups",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("opsflow-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in HEADLINES:
        runs = []
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        times[name] = round(min(runs), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline queries, total of best runs",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
