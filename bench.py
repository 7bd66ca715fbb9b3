"""Time the headline queries; prints one JSON line.

Each query is run to completion without bringing its rows to the driver, three times
after one warm-up; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import tempfile
import time

from pyspark.sql import SparkSession

from workload.queries import queries

HEADLINE = [
    "canonical_lineitem",
    "row_fingerprint_lineitem",
    "bucket_checksum_lineitem",
    "bucket_checksum_documents",
    "checksum_diff_orders",
    "checksum_clean_lineitem",
    "row_multiplicity_orders",
    "row_diff_orders",
    "row_diff_events",
    "row_diff_documents",
    "row_diff_hot_rows",
    "row_diff_check_orders",
    "diff_sample_source",
    "schema_diff_parts",
    "table_inventory_check",
    "verdict_summary",
    "compare_table_orders",
    "compare_table_clean_lineitem",
]


def session(cpus: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    registered = queries()
    seconds: dict[str, float] = {}
    for name in HEADLINE:
        times = []
        for _ in range(4):
            start = time.perf_counter()
            registered[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
