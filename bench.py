"""Headline-query benchmark.

Runs the headline queries on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1)
with ``local[$BENCH_CPUS]`` and prints ONE JSON line.  Each query is fully
executed into the ``noop`` sink (no collect to the driver).
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_bars", "technical_indicators", "feature_stack", "pair_correlations",
    "market_features", "backtest", "performance_core", "score_allocations",
    "request_rates", "api_alerts", "training_progress", "describe_bars",
    "retain_latest", "stream_hourly_bars",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from tickloom.plans.catalog import QUERIES
    from tickloom.session import get_session, release_tables

    spark = get_session(f"local[{cpus}]", shuffle_partitions=max(8, 2 * cpus))
    # Warm-up, not timed, on the smallest scale: every headline query (default;
    # JIT, generated code and Python workers in place) or, with
    # BENCH_WARMUP=first, only the first one.
    warm = "/root/testdata/sf0.001"
    for name in (HEADLINE if os.environ.get("BENCH_WARMUP", "all") == "all" else HEADLINE[:1]):
        QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
        release_tables(spark)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_total_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "warmup": os.environ.get("BENCH_WARMUP", "all") + " at sf0.001"}))


if __name__ == "__main__":
    main()
