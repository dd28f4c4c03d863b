"""Summarise the physical plan of every registered query (writes PLANS.md).

Usage: python tools/plan_summary.py [sf_dir]
AQE is switched off here only so that the static plan is shown in full.
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def _nodes(node):
    """All nodes of a physical plan (children and the plans under reused exchanges)."""
    out, stack = [], [node]
    while stack:
        n = stack.pop()
        out.append(n)
        kids = n.children()
        stack.extend(kids.apply(i) for i in range(kids.size()))
    return out


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from shiftmetrics.session import local_session
    spark = local_session(8)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    from shiftmetrics.registry import ALL_QUERIES
    from shiftmetrics.sources.fixtures import bind_fixture
    rows = []
    for name, plan_of in ALL_QUERIES.items():
        root = bind_fixture(plan_of)(spark, sf)._jdf.queryExecution().executedPlan()
        plan = root.toString()
        windows = [n for n in _nodes(root) if n.nodeName() == "Window"]
        unpartitioned = sum(1 for w in windows if w.partitionSpec().isEmpty())
        rows.append((name, plan.count("FileScan parquet"), plan.count("Exchange hashpartitioning"),
                     plan.count("ReusedExchange"), plan.count("BroadcastHashJoin"),
                     plan.count("SortMergeJoin"), len(windows), unpartitioned,
                     sum(plan.count(b) for b in ("BroadcastNestedLoopJoin", "CartesianProduct",
                                                  "BatchEvalPython", "ArrowEvalPython"))))
    out = ["# Physical plans", "",
           f"Static plans (AQE off) of every query of the reference over the fixture tables ({sf}).",
           "`windows w/o key` are windows without a partition key: they run only over per-bucket or",
           "per-day summaries (calendar-sized), never over sample rows.  `banned` counts nested-loop joins,",
           "Cartesian products and Python UDF operators (must be 0).  `report_cells`, over checkpointed",
           "mart inputs, shows only the final, small plan.", "",
           "| query | scans | hash exchanges | reused | broadcast joins | sort-merge joins | windows | windows w/o key | banned |",
           "|---|---|---|---|---|---|---|---|---|"]
    out += [f"| `{r[0]}` | " + " | ".join(str(x) for x in r[1:]) + " |" for r in rows]
    path = os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    open(path, "w").write("\n".join(out) + "\n")
    print(path)


if __name__ == "__main__":
    main()
