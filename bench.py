"""Benchmark the headline queries; prints one JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_RUNS (default 5, median reported after one warm-up run).
Each query runs to completion through the ``noop`` sink (no driver collect).
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["fraud_report", "fraud_city", "fraud_amount", "fraud_passport", "fraud_contract",
            "scd2_history", "fraud_city_parity", "audit_counts"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "5"))
    from cardwatch.session import get_session
    from cardwatch.plans.queries import registry
    spark = get_session(f"local[{cpus}]", shuffle_partitions=cpus)
    reg = registry()
    times: dict[str, float] = {}
    rows: dict[str, int] = {}
    for name in HEADLINE:
        q = reg[name]
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()  # warm-up
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            q(spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
        rows[name] = q(spark, sf_dir).count()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_total_median", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "rows": rows, "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus, "runs": runs, "shuffle_partitions": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
