"""Summarise the physical plans of registered queries (PLANS.md).

usage: python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import contextlib
import io
import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

NAMES = ["stg_daily_prices", "prices_with_technicals", "daily_market_snapshot", "corr_matrix", "regime_analysis",
         "sector_performance", "share_of_total", "dedup_latest", "date_range_filter", "universe_filter", "top_n",
         "forward_fill", "rolling_correlation", "daily_downsample"]


def main(argv):
    sf_dir = argv[0] if argv else "/root/testdata/sf0.01"
    from tidemark.plans.registry import REGISTRY
    from tidemark.session import apply_core_conf, local_session
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    print("# Physical plan summary\n")
    print(f"Generated by `tools/plan_summary.py` on `{sf_dir}` (adaptive plans before execution; AQE may "
          "turn sort-merge joins into broadcast joins at runtime after measuring the sides).\n")
    print("| query | exchanges | sorts | windows | group limits | hash aggs | broadcast joins | sort-merge joins | scans |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    details = []
    for name in NAMES:
        df = REGISTRY[name].build(spark, sf_dir)
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain()
        plan = buf.getvalue()
        tree = plan.split("\n\n")[0]
        c = {k: len(re.findall(p, tree)) for k, p in {
            "ex": r"Exchange ", "sort": r"\bSort \[", "win": r"\bWindow \[", "wgl": r"WindowGroupLimit",
            "agg": r"HashAggregate", "bhj": r"BroadcastHashJoin", "smj": r"SortMergeJoin", "scan": r"FileScan"}.items()}
        print(f"| `{name}` | {c['ex']} | {c['sort']} | {c['win']} | {c['wgl']} | {c['agg']} | {c['bhj']} | {c['smj']} | {c['scan']} |")
        scans = [ln.strip() for ln in tree.splitlines() if "FileScan" in ln]
        details.append((name, scans))
    print("\n## Scans (column pruning and pushed filters)\n")
    for name, scans in details:
        print(f"### {name}\n")
        for sc in scans:
            m = re.search(r"FileScan parquet \[([^\]]*)\].*?(PushedFilters: \[[^\]]*\]).*?(ReadSchema: [^\n]*)", sc)
            if m:
                print(f"- columns `{m.group(1)[:160]}`; {m.group(2)[:200]}")
        print()


if __name__ == "__main__":
    main(sys.argv[1:])
