"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local task slots.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from byteloom.plans import queries as plans
from byteloom.plans.session import CALL_SITES

HEADLINE = (
    "batch_decode",
    "flatten_wide",
    "decode_long",
    "decode_records",
    "decode_null_mode",
    "flatten_json_map",
    "forward_fill",
    "row_chunks",
    "first_n_per_family",
    "validity_flags",
    "length_stats",
    "error_counts",
    "decoding_summary",
    "inspect_bytes",
    "zip_log_lines",
    "union_by_name",
    "sink_append_merge",
)


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("byteloom-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config(CALL_SITES, "false")
        .getOrCreate()
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    available = plans.queries()
    # The catalog is compiled once per session, as a job would do it.
    for options in ({}, {"dedup": "all"}):
        plans.field_catalog(spark, **options).small
    seconds, building = {}, {}
    for name in HEADLINE:
        start = time.time()
        result = available[name](spark, sf_dir)
        building[name] = round(time.time() - start, 3)
        result.write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total seconds of the headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "plan_building": building,
                "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1],
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
