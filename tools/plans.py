"""Summarise the executed physical plan of every registered query.

Usage: python tools/plans.py [sf_dir] > PLANS.md
For each query: shuffles (Exchange), joins by kind, scans with their read
schema and pushed filters, and whether Python runs in the plan.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from sensorqc.session import local_session  # noqa: E402


def summarise(plan: str) -> dict:
    scans = re.findall(r"FileScan parquet \[[^\]]*\].*?ReadSchema: (struct<[^>]*>)", plan)
    pushed = re.findall(r"PushedFilters: \[([^\]]*)\]", plan)
    return {
        "hash shuffles": len(re.findall(r"Exchange hashpartitioning", plan)),
        "range shuffles": len(re.findall(r"Exchange rangepartitioning", plan)),
        "single-partition": len(re.findall(r"Exchange SinglePartition", plan)),
        "broadcasts": len(re.findall(r"BroadcastExchange", plan)),
        "sort-merge joins": plan.count("SortMergeJoin"),
        "broadcast hash joins": plan.count("BroadcastHashJoin"),
        "nested-loop joins (one-row sides)": plan.count("BroadcastNestedLoopJoin"),
        "reused exchanges": plan.count("ReusedExchange"),
        "windows": len(re.findall(r"\bWindow \[", plan)),
        "python": bool(re.search(r"MapInPandas|FlatMapGroupsInPandas|ArrowEvalPython|BatchEvalPython", plan)),
        "top-k": plan.count("TakeOrderedAndProject"),
        "scans": sorted(set(scans)),
        "pushed": sorted({p for p in pushed if p}),
    }


def main() -> None:
    from sensorqc.plans import registry
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = local_session()
    print("# Physical plans of the registered queries\n")
    print(f"Generated by `python tools/plans.py {sf_dir}` after running each query "
          "(final adaptive plans). Counts are of operators in the executed plan.\n")
    for name, fn in registry.queries().items():
        df = fn(spark, sf_dir)
        df.collect()  # the adaptive plan is final once this very DataFrame has run
        plan = df._jdf.queryExecution().executedPlan().toString()
        if "== Final Plan ==" in plan:
            plan = plan[plan.index("== Final Plan =="):plan.index("== Initial Plan ==")]
        s = summarise(plan)
        counts = ", ".join(f"{k} {v}" for k, v in s.items() if k not in ("scans", "pushed") and v)
        print(f"## {name}\n\n{counts or 'no shuffle'}\n")
        for sc in s["scans"]:
            print(f"* ReadSchema `{sc}`")
        for p in s["pushed"]:
            print(f"* PushedFilters `[{p[:300]}]`")
        print()


if __name__ == "__main__":
    main()
