"""Benchmark: headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR.

Prints one JSON line. Each query (plan construction + full execution into
a no-op sink) runs once to warm up, then is timed as the median of
$BENCH_REPEAT runs.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["prices_with_technicals", "daily_market_snapshot", "sector_performance", "corr_matrix",
            "regime_analysis", "asset_prices", "conditional_left_join", "stg_daily_prices", "share_of_total",
            "dedup_latest", "compare_assets"]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    from tidemark.session import local_session
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", cpus)))
    spark.sparkContext.setLogLevel("ERROR")
    from tidemark.plans.registry import REGISTRY
    # The library plans themselves; queries() adds only the oracle-side rounding.
    qs = {name: q.build for name, q in REGISTRY.items()}
    from tidemark.session import apply_core_conf
    apply_core_conf(spark)
    names = [n for n in HEADLINE if n in qs]
    if len(sys.argv) > 1:
        names = sys.argv[1:]
    times = {}
    if len(sys.argv) == 1:  # the stored layer that the medallion queries read, as a line of its own
        from tidemark.plans.pipeline import persisted_bronze
        t = time.perf_counter()
        for load in persisted_bronze(spark, sf_dir).values():
            load()
        times["bronze_build"] = round(time.perf_counter() - t, 3)
    for name in names:
        def run():
            t = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            return time.perf_counter() - t
        run()
        times[name] = round(statistics.median(run() for _ in range(repeat)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "median_query_seconds_total", "value": round(sum(v for k, v in times.items() if k != "bronze_build"), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus}))


if __name__ == "__main__":
    main()
