"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) choose data and
cores; BENCH_ONLY, a comma list, restricts the queries.  Results go to the noop sink;
each time is the median of three runs after a warm-up.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tidemark.catalogue import QUERIES
from tidemark.session import local_session

HEADLINE = (
    "r1_latest_state", "r2_current", "r3_snapshot_merge", "r3_orders_merge", "r4_exclude_live", "r5_event_rate",
    "r6_refresh", "t4_remap", "t6_route", "t9_reject_counts", "t9_route_rejects", "v_convert_orders",
    "v_convert_lineitem", "k3_json_rows", "k3_json_documents", "k3_json_lineitem", "k5_conform", "b1_batches",
    "k4_report", "s4_envelope", "s5_committed", "s5_transactions", "s6_casts", "f3_key_profile",
    "f4_page", "f5_pages", "f5_pages_ties", "f5_pages_text", "f6_windows", "f6_lineitem_windows", "f6_copy",
    "f8_job_states", "f9_audit", "f10_progress", "f11_copy_pages", "k1_staged", "k2_load",
    "m1_view", "m3_drain", "f5_pages_time", "f5_pages_price", "stream_replicate", "stream_latest_state", "stream_envelopes", "stream_event_rate",
)
RUNS = 3


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = os.environ.get("BENCH_ONLY")
    names = only.split(",") if only else HEADLINE
    partitions = int(cpus) if cpus.isdigit() else 8
    spark = local_session(cpus=cpus, shuffle_partitions=partitions)

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in names:
        run(name)
        seconds[name] = round(statistics.median(run(name) for _ in range(RUNS)), 3)
        print(f"{name:24} {seconds[name]:7.3f}", file=sys.stderr, flush=True)
    print(json.dumps({
        "metric": "headline queries, sum of medians", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))


if __name__ == "__main__":
    main()
