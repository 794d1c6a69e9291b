"""Run queries and summarise their final (adaptive) physical plans.

Usage: python tools/show_plans.py [sf_dir] [query ...]
"""
from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from rareseries import queries as Q  # noqa: E402
from rareseries.session import local_session  # noqa: E402

PATTERNS = {
    "shuffle exchanges": r"\bExchange hashpartitioning|\bExchange rangepartitioning|\bExchange SinglePartition",
    "reused exchanges": r"ReusedExchange",
    "broadcast exchanges": r"BroadcastExchange",
    "sort-merge joins": r"SortMergeJoin",
    "broadcast joins": r"BroadcastHashJoin",
    "windows": r"\bWindow \[",
    "partial group limits": r"WindowGroupLimit",
    "top-k": r"TakeOrderedAndProject",
    "python (Arrow) operators": r"MapInPandas|ArrowEvalPython|FlatMapGroupsInPandas",
}


def summary(df) -> tuple[dict, list[str]]:
    df.collect()  # the same DataFrame's adaptive plan is final after its own action
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    lines = plan.splitlines()
    counts = {k: sum(1 for ln in lines if re.search(p, ln) and (k == "reused exchanges" or "ReusedExchange" not in ln))
              for k, p in PATTERNS.items()}
    scans = sorted({m for m in re.findall(r"ReadSchema: (struct<[^>]*>)", plan)})
    pushed = sorted({m for m in re.findall(r"PushedFilters: (\[[^\]]*\])", plan) if m != "[]"})
    return counts, scans + pushed


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or ["flagship", "scan_events", "scan_entries", "scan_event_types", "limit_new", "topk_rare",
                             "pull_many", "resume_anti", "embedding"]
    spark = local_session(8)
    for name in names:
        df = Q.scan_of(spark, sf, "events") if name == "flagship" else Q.QUERIES[name](spark, sf)
        counts, scans = summary(df)
        print(f"## {name}")
        print(", ".join(f"{k}: {v}" for k, v in counts.items() if v))
        for s in scans:
            print("   ", s)


if __name__ == "__main__":
    main()
