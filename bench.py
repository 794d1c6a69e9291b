"""Benchmark the headline queries; prints one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list to run a subset). Every query is run to completion
with the ``noop`` sink and starts from the raw tables (no cache carried over),
after one untimed warm-up pass of every query over the sf0.001 tables.
"""
from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rareseries import queries as Q  # noqa: E402
from rareseries.session import local_session  # noqa: E402

HEADLINE = [
    "scan_events", "scan_events_gaps", "scan_orders", "scan_lineitem", "scan_entries", "scan_wide", "scan_event_types",
    "level_counts", "content_hash", "embedding", "build_series", "scan_summary", "dedupe_first",
    "numeric_profile", "profile_catalog", "pull_many", "granularity",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=max(8, int(cpus) * 2) if cpus.isdigit() else 8)
    warm = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.001")
    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        # JVM/JIT warm-up of every code path on the smallest tables; not timed.
        for name in names:
            Q.QUERIES[name](spark, warm).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        Q.clear_cache()
        t0 = time.time()
        Q.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
        print(f"{name}: {times[name]}s", file=sys.stderr)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
