"""Time the registered queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default
8), BENCH_QUERIES (comma-separated names, default all headline queries),
BENCH_RUNS (default 1 timed run after one warm-up run).  Each run executes the
whole query into a sink that discards rows.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from nodecast.catalog.queries import QUERIES
from nodecast.session import local_session, release

HEADLINE = (
    "node_coverage_topn", "bucket_mean", "metric_full_outer_join", "metric_conditional_wide",
    "aligned_machine_metrics", "core_temperatures", "complete_grid_left_join",
    "prepared_telemetry", "quality_overview", "sampling_gap", "missing_percent",
    "numeric_ranges", "node_ranges", "duplicate_keys", "lag_features", "rolling_std",
    "supervised_target", "supervised_full", "inference_rows", "latest_per_node",
    "split_counts", "train_part_medians", "persistence_metrics", "event_proxy",
    "residual_histogram", "comparison_union", "ridge_forecast",
)


def run(spark, folder: str, name: str) -> float:
    started = time.perf_counter()
    QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    taken = time.perf_counter() - started
    release(spark)
    return taken


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    if chosen == "all":
        names = tuple(QUERIES)
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = local_session(cpus, **{"spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8"})
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        run(spark, folder, name)
        seconds[name] = round(statistics.median(run(spark, folder, name) for _ in range(runs)), 3)
        print(f"{name:32} {seconds[name]:8.2f} s", file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(folder).name.removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
