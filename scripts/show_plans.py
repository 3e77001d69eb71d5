"""Summarise the final (adaptive) physical plan of registered queries:
shuffles, reused shuffles, broadcasts, sort-merge joins, Python stages and
what each parquet scan reads (ReadSchema) and pushes down (PushedFilters).

usage: python scripts/show_plans.py [sf_dir] [name-substring ...] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from canvass.plans import all_queries  # noqa: E402
from canvass.session import build_session  # noqa: E402


def summarise(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition|\bExchange RoundRobin", plan)),
        "reused": plan.count("ReusedExchange"),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python": len(re.findall(r"MapInPandas|ArrowEvalPython|BatchEvalPython", plan)),
        "scans": sorted(set(re.findall(r"FileScan parquet [^\n]*?Location: [^\n]*?\[([^\]]*)\]", plan))),
        "pushed": sorted(set(p for p in re.findall(r"PushedFilters: \[([^\]\n]*)\]", plan) if p)),
    }


def main():
    args = sys.argv[1:]
    sf_dir = args[0] if args and os.path.isdir(args[0]) else "/root/testdata/sf0.01"
    pats = [a for a in args if not os.path.isdir(a)]
    spark = build_session(extra={"spark.sql.maxMetadataStringLength": "1000"})
    qs, _ = all_queries()
    print(f"# Final physical plans at {sf_dir} (local[8], AQE on)\n")
    print("| query | shuffles | reused | broadcast joins | SMJ | windows | python | pushed filters |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in qs.items():
        if pats and not any(p in name for p in pats):
            continue
        df = fn(spark, sf_dir)
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = plan.split("== Initial Plan ==")[0]      # adaptive: keep the final plan only
        s = summarise(plan)
        pushed = "; ".join(s["pushed"])[:160]
        print(f"| {name} | {s['shuffles']} | {s['reused']} | {s['broadcast_joins']} | {s['sort_merge_joins']} "
              f"| {s['windows']} | {s['python']} | {pushed} |")


if __name__ == "__main__":
    main()
