"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line."""

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from hitlens import catalog
from hitlens.catalog import base

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINES = [
    "flagship",
    "s02_pair_lines",
    "enrich_all",
    "l15_overview",
    "l43_dimension_analysis",
    "l16_hottest_apis",
    "a01_api_performance",
    "a05_service_report",
    "a11_slow_diagnosis",
    "a22_time_hour",
    "a23_occupancy",
    "a28_concurrency",
    "a33_ip_report",
    "a39_header_performance",
    "a41_interface_errors",
    "a48_error_bursts",
    "a49_cdn_buckets",
    "d12_status_counts",
    "j03_ip_range_join",
    "m07_daily",
    "r01_api_performance",
    "r12_comprehensive",
    "t02_top_per_group",
    "x03_merged_state",
]

WARM_UP = ["flagship", "enrich_all", "r01_api_performance", "a28_concurrency", "m07_daily"]


# reports as they run on a cluster: over the enriched table, written once, instead of over raw rows
STORED = ["r01_api_performance", "r12_comprehensive", "l16_hottest_apis", "a33_ip_report"]


def stored(spark: SparkSession, queries) -> dict:
    path = base.scratch(spark, "bench")
    start = time.perf_counter()
    base.hits(spark, SF_DIR).write.parquet(path)
    took = {"write_enriched": round(time.perf_counter() - start, 3)}
    with base.enriched_from(spark, SF_DIR, spark.read.parquet(path)):
        for name in STORED:
            start = time.perf_counter()
            queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            took[name] = round(time.perf_counter() - start, 3)
    return took


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", str(2 * int(CPUS)))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    names = sys.argv[1:] or HEADLINES
    # class loading and code paths warm up on the smallest data set; results come from SF_DIR only
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    for name in WARM_UP if os.path.isdir(small) else []:
        queries[name](spark, small).write.format("noop").mode("overwrite").save()
    took = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        took[name] = round(time.perf_counter() - start, 3)
        print(name, took[name], file=sys.stderr)
    rows = spark.read.parquet(f"{SF_DIR}/events.parquet").count()
    result = {
        "metric": "total headline query time",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": SF_DIR.rsplit("sf", 1)[-1],
        "requests": rows,
    }
    if "enrich_all" in took:
        rate = rows / took["enrich_all"]
        result |= {"enriched_records_per_second": round(rate), "enriched_records_per_second_and_core": round(rate / int(CPUS))}
    if not sys.argv[1:]:
        result["stored"] = stored(spark, queries)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
