"""Headline queries on local[$BENCH_CPUS]; prints one JSON line.

Each query is built, run in full into a no-op sink and timed as a whole: one warm-up, then
the median of $BENCH_RUNS runs.
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from workload.queries import QUERIES

HEADLINE = (
    "pairs_nearest_preceding", "pairs_per_block",
    "agg_all_scopes", "agg_top_level", "agg_dirty_log", "agg_nearest_preceding", "agg_per_block",
    "scored_lineage", "slim_lineage", "join_patterns", "ragged_lineage",
    "usage_rollup", "column_usage", "health_summary", "recommendations",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = os.environ.get("BENCH_QUERIES")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("joinscope-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in only.split(",") if only else HEADLINE:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(runs)), 3)

    logged = spark.read.parquet(f"{sf_dir}/orders.parquet").count()
    rate = {n: round(logged / s) for n, s in seconds.items() if n.startswith(("pairs_", "agg_", "scored", "slim", "ragged"))}
    print(
        json.dumps(
            {
                "metric": "total seconds of headline queries",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "log_rows": logged,
                "log_rows_per_second": rate,
                "sf": os.path.basename(sf_dir.rstrip("/")),
                "cpus": int(cpus),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
