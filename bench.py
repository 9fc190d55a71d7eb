"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8)
choose the data and the cores.  Each query is built, planned and fully computed
into a no-op sink, twice; the faster run counts, so that code generation and the
JVM's warm-up do not outweigh the work on such small data.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from workload.queries import QUERIES  # noqa: E402

HEADLINE = (
    "extract_simple",
    "extract_robust",
    "extract_robust_documents",
    "grade_simple",
    "grade_equiv",
    "grade_runs",
    "grade_dedup",
    "grade_dedup_counts",
    "accuracy_by_method",
    "accuracy_cube",
    "per_example",
    "outcome_counts",
    "pass_at_k_curve",
    "pass_at_k_orders",
    "split_commas",
    "shard_mod",
    "token_logprob",
    "avg_entropy",
    "accept_rate",
    "mh_state_carry",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    runs = {name: [round(run(name), 3), round(run(name), 3)] for name in HEADLINE}
    times = {name: min(both) for name, both in runs.items()}
    run_rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").count()
    scale = re.search(r"sf([0-9.]+)/?$", sf_dir)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "both_runs": runs,
                "sf": float(scale[1]) if scale else sf_dir,
                "run_rows": run_rows,
                "rows_per_sec": {
                    name: round(run_rows / times[name])
                    for name in ("extract_robust", "grade_runs", "grade_dedup", "pass_at_k_curve")
                },
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
