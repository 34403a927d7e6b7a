"""Headline-query timings.

Runs the main queries at $BENCH_SF_DIR (default /root/testdata/sf0.1) on
local[$BENCH_CPUS] and prints ONE JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

Each query is forced with the `noop` sink (the whole plan runs, nothing is
collected to the driver). Timing includes planning and, for queries that
materialize an intermediate table, that write.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from ledgerline.plans import catalog  # noqa: E402
from ledgerline.session import build_session, cleanup_scratch  # noqa: E402

HEADLINE = [
    "normalize_bills",  # the composed job
    "a6_status",  # status per manifest record (whole job + J1/J2)
    "o5_order",  # skew-safe sheet order
    "k1_sheet",  # upload sheet rows
    "run_csv",  # the whole run, CSV files to sheets and status
    "s1_scan_bills",  # CSV source with per-file header mapping
    "p1_parse",  # description split
    "w1_latest",  # latest row per key
    "a4_first_per_key",
    "p22_flatten",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2)
    qs = catalog.queries()
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    # One untimed run of the flagship first: JVM start-up, class loading and
    # JIT warm-up otherwise land on whichever query happens to run first.
    t0 = time.perf_counter()
    qs["normalize_bills"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    warmup = round(time.perf_counter() - t0, 3)
    times: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": int(cpus),
        "warmup_sec": warmup,
    }))
    cleanup_scratch(spark)  # the intermediate tables this run wrote
    spark.stop()


if __name__ == "__main__":
    main()
