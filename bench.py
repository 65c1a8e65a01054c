"""Time the headline queries; prints one JSON line.

Each query runs once after a small warm-up of the session, and its whole result is consumed.
"""

from __future__ import annotations

import json
import os
import time

from emberfold.plans.queries import QUERIES
from emberfold.session import build_session

HEADLINE = [
    "golden_union",
    "dedup_spacetime",
    "points_in_or_near",
    "dbscan_all",
    "dbscan_near_polygons",
    "asof_weather",
    "aq_composite",
    "severity",
    "risk_score",
    "report_kpis",
    "best_scene",
    "band_stretch",
    "jsonl_audit",
    "firms_csv_scan",
    "stream_best_of_bucket",
    "incidents_flat",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("emberfold-bench", cpus=cpus)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf_dir}/events.parquet").groupBy("event_type").count().collect()
    seconds = {}
    for name in HEADLINE:
        started = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
