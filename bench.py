"""Benchmark: every registered query at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is forced with a ``noop`` write (full computation, nothing collected
to the driver).  One warm-up query is run first and not counted.  Prints ONE
JSON line: {"metric", "value", "unit", "queries", "sf", ...}.

Environment: BENCH_SF_DIR, BENCH_CPUS, BENCH_REPEAT (best of N), BENCH_QUERIES (comma list),
BENCH_EVENT_LOG (folder for Spark's event log, for stage and task times).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from eventlake.plans.catalog import QUERIES  # noqa: E402
from eventlake.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "1"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {}
    if os.environ.get("BENCH_EVENT_LOG"):      # stage/task times without any UI: Spark's event log
        extra = {"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG"]}
    spark = build_session(master=f"local[{cpus}]", app_name="eventlake-bench",
                          shuffle_partitions=int(cpus), extra_conf=extra)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    try:   # warm-up (JIT, file listing caches); not measured
        QUERIES["query_hash_stats"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    except Exception:  # noqa: BLE001 - the measured run reports it
        pass

    timings, failed = {}, {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        best = None
        try:
            for _ in range(repeat):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                best = dt if best is None else min(best, dt)
            timings[name] = round(best, 3)
        except Exception as e:  # noqa: BLE001 - report the failure, keep measuring the rest
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
    total = round(sum(timings.values()), 3)
    out = {"metric": "total_query_seconds", "value": total, "unit": "sec",
           "queries": timings, "sf": sf, "cpus": int(cpus), "spark": spark.version}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
