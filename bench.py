"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 2, the best is reported).
"""

from __future__ import annotations

import json
import os
import time

from loomvec.plans.catalog import QUERIES
from loomvec.session import build_session, drop_scratch

HEADLINE = [
    "clean_text",
    "read_records",
    "embed",
    "write_and_resume",
    "truncate_embedding",
    "vector_json",
    "bucketed_batches",
    "consolidate",
    "reconcile",
    "trial_metrics",
    "latency_by_trial",
    "rolling_latency",
    "interval_rate",
    "best_config",
    "embed_stream",
    "throughput_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = build_session(
        "loomvec-bench",
        master=f"local[{cpus}]",
        **{
            "spark.ui.enabled": "false",
            "spark.driver.memory": "8g",
            "spark.sql.shuffle.partitions": cpus,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JVM's and Python's workers outside the measurement.
    QUERIES["embed"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {}
    for name in HEADLINE:
        best = float("inf")
        for _ in range(runs):
            started = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            best = min(best, time.perf_counter() - started)
        times[name] = round(best, 3)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").count()
    drop_scratch(spark)
    print(
        json.dumps(
            {
                "metric": "headline queries, total wall time",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir).removeprefix("sf"),
                "embed_docs_per_sec": round(docs / times["embed"], 1),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
