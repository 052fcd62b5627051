"""Headline queries, warm wall time. Prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8), BENCH_QUERIES (comma-separated).
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from workload import QUERIES

HEADLINE = ["gold_fact", "gold_fact_grain", "mart_sales", "cdc_upsert", "cdc_dedup_latest", "cdc_dedup_composite",
            "cdc_soft_delete", "cdc_silver_step", "tbl_version_as_of", "silver_order_item", "prof_describe",
            "prof_crosstab", "text_clean", "text_tfidf"]
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("bench")
             .config("spark.ui.enabled", "false").config("spark.driver.memory", "16g")
             .config("spark.sql.shuffle.partitions", cpus).config("spark.sql.session.timeZone", "UTC").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        best = None
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        times[name] = round(best, 3)
    spark.stop()
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(sf_dir).removeprefix("sf")}))


if __name__ == "__main__":
    main()
