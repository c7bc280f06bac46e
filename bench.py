"""Time the headline queries: one warm-up, then the median of BENCH_RUNS runs each.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 3), BENCH_QUERIES (comma-separated; default the headline list).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from ledgerbrook.plans.queries import REGISTRY  # noqa: E402
from ledgerbrook.session import build_session  # noqa: E402

HEADLINES = (
    "clean_transactions", "enrich_transactions", "fact_transactions", "dq_results", "fraud_score",
    "fraud_summary", "daily_branch_metrics", "customer_segment_summary", "branch_rollup",
    "scd2_customer", "upsert_transactions", "incremental_late", "reconcile", "dq_passed", "fraud_alerts",
    "fraud_large_tx",
)


def seconds(build, spark, sf_dir: str) -> float:
    start = time.perf_counter()
    build(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    wanted = os.environ.get("BENCH_QUERIES", "")
    names = list(REGISTRY) if wanted == "all" else [n for n in wanted.split(",") if n] or list(HEADLINES)
    spark = build_session(
        "bench", f"local[{cpus}]",
        **{"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
           "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in names:
        seconds(REGISTRY[name], spark, sf_dir)
        times[name] = round(statistics.median(seconds(REGISTRY[name], spark, sf_dir) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total of median query times", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": int(cpus), "runs": runs,
        "spark": spark.version, "driver_memory": "8g",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
