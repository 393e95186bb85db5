"""Benchmark: wall time of the registered queries at one scale factor.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query runs to completion into Spark's ``noop`` sink (the whole plan executes,
nothing is shipped to the driver).  A short warm-up pass on the smallest data set
loads classes and JIT-compiles first; it is not timed.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tierline.queries import QUERIES  # noqa: E402
from tierline.session import local_session  # noqa: E402

WARMUP_DIR = "/root/testdata/sf0.001"
# One query per code path (gold plans, window dedup, FK join, upsert, streaming load).
WARMUP = ["gold_campaign_performance", "dedup_lineitem", "fk_flag_events_supplier", "merge_upsert",
          "ingest_incremental"]


def run(spark, name: str, sf_dir: str) -> float:
    t0 = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    names = only or list(QUERIES)
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    warmed = []
    if os.path.isdir(WARMUP_DIR):
        for name in WARMUP:
            run(spark, name, WARMUP_DIR)
            warmed.append(name)
    times, errors = {}, {}
    for name in names:
        try:
            times[name] = round(run(spark, name, sf_dir), 3)
        except Exception as e:  # noqa: BLE001  -- record it, keep timing the rest
            times[name] = None
            errors[name] = f"{type(e).__name__}: {str(e)[:300]}"
    spark.stop()
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "total_query_wall_time",
        "value": round(sum(t for t in times.values() if t is not None), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "warmup": {"dir": WARMUP_DIR, "queries": warmed, "timed": False},
    }
    if errors:
        out["errors"] = errors
    print(json.dumps(out))


if __name__ == "__main__":
    main()
