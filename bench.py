"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR  folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS    local cores (default 8)
BENCH_RUNS    passes over the queries (default 2); the faster time of each counts

``recommend_model`` grows its 300 trees in the first pass only.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload import queries as Q  # noqa: E402

HEADLINE = [
    "dim_user_key", "dim_address_key", "dim_film_bridge_min", "dim_producer_unknown", "dim_calendar",
    "dense_key_lines", "latest_payer", "fact_rating", "fact_revenue", "update_from_match", "rollup_revenue",
    "mode_by_user", "user_home_state", "training_set", "catalogue_extract", "candidates_top_n",
    "top_k_per_group", "drop_duplicate_lines", "cross_score_topk", "prediction_fact", "describe_lines",
    "check_unique", "check_fk", "sample_pairs", "ingest_landing", "top_1500_per_group", "pair_all_candidates",
]
ONCE = ["recommend_model"]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for k in range(runs):
        for name in HEADLINE + ([] if k else ONCE):
            begin = time.perf_counter()
            Q.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
            took = round(time.perf_counter() - begin, 3)
            seconds[name] = min(took, seconds.get(name, took))
    spark.stop()
    print(
        json.dumps(
            {
                "metric": f"headline_total_best_of_{runs}",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
