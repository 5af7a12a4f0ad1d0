"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, optional).  Each query's result is fully computed
with the ``noop`` sink (no collect to the driver).  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "clean_order_lines",
    "order_metrics",
    "customer_metrics",
    "product_metrics",
    "calendar",
    "customer_history",
    "sales_fact",
    "check_not_null",
    "daily_metrics",
    "churn_features",
    "customer_360",
    "check_relationships",
    "sales_fact_incremental",
]


def main() -> None:
    from starmart.plans.queries import REGISTRY
    from starmart.session import local_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = local_session(cpus=cpus, shuffle_partitions=int(cpus) * 2)
    spark.sparkContext.setLogLevel("ERROR")

    # warm-up: JVM start, parquet footers, codegen caches
    REGISTRY["raw_order_lines"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    timings: dict[str, float] = {}
    failed: dict[str, str] = {}
    for name in names:
        t0 = time.perf_counter()
        try:
            REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        except Exception as exc:  # noqa: BLE001 - report and keep measuring the rest
            failed[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
            print(f"{name}: FAILED {failed[name]}", file=sys.stderr, flush=True)
            continue
        timings[name] = round(time.perf_counter() - t0, 3)
        print(f"{name}: {timings[name]}s", file=sys.stderr, flush=True)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else sf_dir,
        **({"failed": failed} if failed else {}),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
