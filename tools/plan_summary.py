"""Summarise the physical plan of every registered query (sf0.01) into PLANS.md.

For each query: shuffles (hash/range/round-robin exchanges), broadcasts, the
filters pushed into the Parquet scan, the columns the scan reads, and whether a
window, a sort-based aggregate or any Python evaluation appears.  Plans are taken
after execution (``noop`` write) so AQE's final choices are shown.

    python tools/plan_summary.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventlake.plans.catalog import QUERIES  # noqa: E402
from eventlake.session import build_session  # noqa: E402


def summarise(plan: str) -> dict[str, str]:
    exch = re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)", plan)
    kinds = {}
    for e in exch:
        kinds[e] = kinds.get(e, 0) + 1
    pushed = sorted(set(re.findall(r"PushedFilters: \[(.*?)(?:\]|\.\.\.), ReadSchema", plan)))
    schemas = sorted(set(re.findall(r"ReadSchema: (struct<[^\n]*?>)(?:,|\n|$)", plan)))
    return {
        "shuffles": ", ".join(f"{v}× {k.replace('partitioning', '').replace('Partitioning', '')}"
                              for k, v in sorted(kinds.items())) or "none",
        "broadcast": str(plan.count("BroadcastExchange")),
        "pushed": "; ".join(p for p in pushed if p) or "-",
        "reads": "; ".join(schemas) or "-",
        "window": "yes" if re.search(r"\bWindow\b", plan) else "",
        "sortagg": "yes" if "SortAggregate" in plan else "",
        "python": "YES" if ("EvalPython" in plan or "PythonUDF" in plan) else "",
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `python tools/plan_summary.py` at `{sf_dir}` on local mode, after execution "
          "(AQE final plans). The `RoundRobin` exchange right after the scan appears only because each test "
          "file is a single row group: the scan is spread over the task slots. A large table scans into "
          "many splits and has no such exchange. Queries that write and read back (`sink_*`, `stream_*`, "
          "`ordered_*`) show the plan of the final read.\n")
    print("| query | shuffles | broadcasts | filters pushed into the scan | scan reads | window | sort-agg | python |")
    print("|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| `{name}` | {s['shuffles']} | {s['broadcast']} | {s['pushed']} | {s['reads']} | "
              f"{s['window']} | {s['sortagg']} | {s['python']} |")


if __name__ == "__main__":
    main()
