"""Physical-plan audit of every registered query: shuffles, broadcasts,
single-partition exchanges, Python nodes, scans and pushed filters.

    python tools/plan_audit.py [sf_dir] > PLANS.md

Writer and streaming queries run their jobs while building the DataFrame;
the plan shown for them is that of the final read-back.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

PY_NODES = ("ArrowEvalPython", "BatchEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "FlatMapGroupsInPandasWithState")


def audit(plan: str) -> dict[str, object]:
    lines = plan.splitlines()
    ex = [ln for ln in lines if re.search(r"\bExchange (hash|range|Single|RoundRobin)", ln)]
    single = [ln for ln in ex if "SinglePartition" in ln]
    scans = [ln for ln in lines if "FileScan" in ln or "Scan ExistingRDD" in ln]
    pushed = [ln for ln in scans if re.search(r"PushedFilters: \[[^\]]", ln) or re.search(r"DataFilters: \[[^\]]", ln)]
    return {
        "shuffles": len(ex),
        "single": len(single),
        "broadcasts": sum("BroadcastExchange" in ln for ln in lines),
        "python": ",".join(sorted({n for n in PY_NODES for ln in lines if n in ln})) or "-",
        "topk": sum("TakeOrderedAndProject" in ln for ln in lines),
        "windows": sum(bool(re.search(r"\bWindow\b|WindowGroupLimit", ln)) for ln in lines),
        "scans": len(scans),
        "filtered_scans": len(pushed),
    }


def main(argv: list[str]) -> int:
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    from pipewatch.plans import registry
    from pipewatch.session import build_session

    spark = build_session(shuffle_partitions=8)
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `tools/plan_audit.py {sf_dir}` (initial AQE plans, before run-time re-planning;")
    print("AQE may still coalesce partitions, convert joins to broadcast after measuring, and split skew).\n")
    print("| query | shuffles | SinglePartition | broadcasts | python | top-k | windows | scans | scans with filters |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- | --- |")
    for name, fn in registry.queries().items():
        try:
            df = fn(spark, sf_dir)
            plan = df._jdf.queryExecution().executedPlan().toString()
            a = audit(plan)
            print(
                f"| {name} | {a['shuffles']} | {a['single']} | {a['broadcasts']} | {a['python']} | {a['topk']} | "
                f"{a['windows']} | {a['scans']} | {a['filtered_scans']} |"
            )
        except Exception as e:  # noqa: BLE001
            print(f"| {name} | error: {type(e).__name__} | | | | | | | |")
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
