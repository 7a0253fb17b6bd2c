"""Stage durations and task counts from Spark event logs (no UI needed).

    BENCH_EVENT_LOG=/tmp/run-x BENCH_QUERIES=capacity_daily python bench.py
    python tools/stage_times.py /tmp/run-x
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys


def events(path: str):
    for f in sorted(p for p in glob.glob(os.path.join(path, "**", "*"), recursive=True) if os.path.isfile(p)):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            import zstandard
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode("utf-8", "replace").splitlines():
            if line.strip():
                yield json.loads(line)


def main() -> None:
    stages = {}
    for e in events(sys.argv[1]):
        if e.get("Event") == "SparkListenerStageCompleted":
            si = e["Stage Info"]
            stages[si["Stage ID"]] = (si.get("Completion Time", 0) - si.get("Submission Time", 0),
                                      si["Number of Tasks"], si["Stage Name"][:70])
    for sid, (ms, n, name) in sorted(stages.items()):
        print(f"stage {sid:>4}  {ms:>7} ms  {n:>6} tasks  {name}")
    print(f"{len(stages)} stages, {sum(v[0] for v in stages.values())} ms in total")


if __name__ == "__main__":
    main()
