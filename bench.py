"""Time the headline queries and print one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_RUNS     timed runs per query after one warm-up (default 3; the median counts)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from tabloom_queries import stages  # noqa: E402
from tabloom_queries.catalog import QUERIES  # noqa: E402

HEADLINE = [
    "raw_profile",
    "missing_profile",
    "numeric_profile",
    "numeric_profile_lineitem",
    "categorical_profile",
    "type_recommendations",
    "deduplicate_first",
    "deduplicate_last",
    "row_id",
    "fill_missing",
    "clip_outliers",
    "parse_dates",
    "build_features",
    "encode_categoricals",
    "correlation_pairs",
    "iv_scores",
    "iv_scores_lineitem",
    "selection_report",
]


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tabloom-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tabloom-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("OFF")
    # The loan view is written once and shared by the queries on it; its cost is listed by itself.
    results = {"loan_view_written": round(timed(lambda: stages.loan(spark, sf_dir).count()), 3)}

    def run(name: str) -> None:
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    for name in HEADLINE:
        run(name)
        results[name] = round(statistics.median(timed(lambda: run(name)) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(results.values()), 3),
                "unit": "sec",
                "queries": results,
                "sf": sf_dir.rstrip("/").rpartition("sf")[2],
                "cpus": int(cpus),
                "runs": runs,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
