"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is built and run to the end once to warm up, then timed (median of three runs).
Results are written to the no-op sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from sparkmart.workload import REGISTRY  # noqa: E402

HEADLINE = [
    "mart_asset_strength_product",
    "mart_asset_strength_linear",
    "mart_subject_priority_product",
    "mart_subject_priority_linear",
    "mart_incident_instructions_product",
    "mart_supply_readiness_product",
    "mart_supply_readiness_linear",
    "mart_interaction_review_product",
    "mart_interaction_review_linear",
    "view_success_rate",
    "view_strength_by_region",
    "asof_left",
    "asof_nearest",
    "join_range_all",
    "latest_per_key",
    "dedupe_composite",
    "cdc_apply_changes",
    "cdc_snapshot_diff",
    "merge_upsert",
    "cdc_stream_ingest",
    "stream_latest_state",
    "mart_month_layout",
    "orphan_check",
    "duplicate_key_check",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    spread: dict[str, list[float]] = {}
    for name in names:
        taken = []
        for attempt in range(runs + 1):
            started = time.perf_counter()
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if attempt or runs == 0:
                taken.append(time.perf_counter() - started)
        seconds[name] = round(statistics.median(taken), 3)
        spread[name] = [round(min(taken), 3), round(max(taken), 3)]
        print(f"{name:40s} {seconds[name]:8.3f}", file=sys.stderr, flush=True)
    events = spark.read.parquet(f"{sf_dir}/events.parquet").count()
    extra = {}
    if "cdc_stream_ingest" in seconds:
        extra["ingest_events_per_sec"] = round(events / seconds["cdc_stream_ingest"], 1)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "spread": spread,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                **extra,
            }
        )
    )


if __name__ == "__main__":
    main()
