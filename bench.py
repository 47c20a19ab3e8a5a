"""Headline queries at one scale: one JSON line with seconds per query (warm, each result fully computed)."""

from __future__ import annotations

import json
import os
import statistics
import time

from cohort_spark.catalog import QUERIES
from cohort_spark.session import local_session

HEADLINE = [
    "entity_features", "discretize", "forward_fill", "forward_fill_chunked", "interpolate_time", "knn_impute", "scale_mixed",
    "aggregate_by_rules", "lag_features", "avg_autocorrelation", "summary_stats", "box_stats", "extract_minimal_features",
    "rank_sums", "evaluate", "silhouette", "build_tzv", "build_sequences", "patient_summaries", "mean_pool",
]


def seconds(spark, build, folder: str) -> float:
    start = time.perf_counter()
    build(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "").split(",")
    spark = local_session(cpus)
    took = {}
    for name in HEADLINE:
        if wanted != [""] and name not in wanted:
            continue
        seconds(spark, QUERIES[name], folder)  # warm up
        took[name] = round(statistics.median(seconds(spark, QUERIES[name], folder) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "cohort queries, total of warm medians",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
