"""Headline queries over one scale factor; prints one JSON line.

Reads BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8).  The
session is warmed up with one query at the measured scale; then every query is planned,
run and fully consumed twice, and the faster run counts.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from policyscan.plans.catalog import QUERIES
from policyscan.session import configure

HEADLINE = [
    "mappings_first_wins",
    "extract_ids",
    "process_batch",
    "conflict_join",
    "extraction_stats",
    "new_mappings_anti",
    "dq_result",
    "result_statistics",
    "statistics_report",
    "text_preprocess",
    "incremental_changed",
    "sink_results_json",
]


def consume(frame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(4 * int(cpus)))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    spark = configure(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    consume(QUERIES[HEADLINE[0]](spark, sf_dir))
    seconds = {}
    for name in HEADLINE:
        runs = []
        for _ in range(2):
            started = time.perf_counter()
            consume(QUERIES[name](spark, sf_dir))
            runs.append(time.perf_counter() - started)
        seconds[name] = round(min(runs), 3)
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
