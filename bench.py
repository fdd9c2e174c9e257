"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default sf0.1) names the tables and ``BENCH_CPUS`` the cores. Every query is run
once on the smallest scale factor to warm up, then up to three times; the median counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession

from shelfwise.registry import QUERIES

HEADLINE = (
    "seller_report",
    "target_items",
    "assortment_gap",
    "gap_with_totals",
    "company_item_units",
    "market_item_totals",
    "clean_catalog",
    "dq_catalog_accepted",
    "dq_company_accepted",
    "dq_competitor_accepted",
    "dq_first_failure",
    "dedupe_keep_one",
    "distinct_item_meta",
    "csv_bronze_roundtrip",
    "upsert_latest",
    "stream_messages",
    "stream_landing_ingest",
    "medallion_end_to_end",
)
WARM_UP = "/root/testdata/sf0.001"
REPEATS = 3
SECONDS_PER_QUERY = 15


def run(query, spark: SparkSession, sf_dir: str) -> float:
    start = time.perf_counter()
    query(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def measure(query, spark: SparkSession, sf_dir: str) -> float:
    times: list[float] = []
    while len(times) < REPEATS and sum(times) < SECONDS_PER_QUERY:
        times.append(run(query, spark, sf_dir))
    return statistics.median(times)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("shelfwise-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    if os.path.isdir(WARM_UP):
        for name in HEADLINE:
            run(QUERIES[name], spark, WARM_UP)
    times = {name: round(measure(QUERIES[name], spark, sf_dir), 3) for name in HEADLINE}
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
