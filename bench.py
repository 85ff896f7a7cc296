"""Times the headline queries and prints one line of JSON.

Each query is run once to load classes and compile, and then timed once, from building
the plan to the last row; boosting, which takes minutes, is run and timed once. Nothing is kept in memory between runs.
"""

from __future__ import annotations

import json
import os
import time

from ebbtide.plans.queries import all_queries
from ebbtide.session import local_session

HEADLINES = (
    "clean_events", "data_quality", "activity_filter", "month_partitions", "event_counts", "customer_recency",
    "customer_features", "labelled_snapshot", "labelled_counts", "pooled_snapshots", "snapshot_summary", "class_weights",
    "feature_matrix_log1p", "score_table", "percentile_buckets", "weak_signal", "rolling_eval", "run_metadata",
    "gbt_scores",
)
SLOW = ("gbt_scores",)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, cores)
    spark.sparkContext.setLogLevel("ERROR")
    queries = all_queries()
    seconds = {}
    for name in HEADLINES:
        for _ in range(1 if name in SLOW else 2):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
    rows = {t: spark.read.parquet(f"{folder}/{t}.parquet").count() for t in ("orders", "lineitem", "events")}
    log_rows = rows["orders"] + rows["lineitem"]
    print(json.dumps({
        "metric": "headline queries, total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": folder.rsplit("sf", 1)[-1],
        "cores": cores,
        "input_rows": rows,
        "log_rows_per_sec": {
            n: round(log_rows / seconds[n]) for n in ("activity_filter", "month_partitions", "customer_features", "pooled_snapshots")
        },
    }))
    spark.stop()


if __name__ == "__main__":
    main()
