"""Times the headline queries over BENCH_SF_DIR on local[BENCH_CPUS] and prints one JSON line."""

from __future__ import annotations

import json
import os
import time

from fieldmart.plans.registry import QUERIES
from fieldmart.session import local_session

HEADLINE = ("dedup_latest", "silver_build", "qc_summary", "quality_report", "similar_phone", "similar_name", "issue_examples", "queue_sync", "message_status", "weekly_percent", "latest_snapshot_per_device", "schema_missing_columns")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, int(cpus), "8g")
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["site_groups"](spark, sf_dir).collect()  # starts the executors
    seconds = {}
    for name in HEADLINE:
        began = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - began, 3)
    print(json.dumps({"metric": "total seconds of the headline queries", "value": round(sum(seconds.values()), 3), "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
