"""Audit the physical plan of every query key for scale hazards.

Reports, per key: shuffle count, single-partition exchanges (with the operator
they gather), nested-loop / cartesian joins, broadcast exchanges, Python UDFs.

usage: python tools/plan_audit.py [sf_dir] > PLANS.md
       python tools/plan_audit.py --codegen [sf_dir]   (executes each key)
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def audit(plan: str) -> dict:
    lines = plan.splitlines()
    single = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            below = lines[i + 1].strip() if i + 1 < len(lines) else ""
            single.append(re.sub(r"#\d+L?", "", below)[:110])
    return {
        "shuffles": sum("Exchange hashpartitioning" in x or "Exchange rangepartitioning" in x
                        or "Exchange RoundRobin" in x for x in lines),
        "single": single,
        "nested_loop": sum("BroadcastNestedLoopJoin" in x or "CartesianProduct" in x
                           for x in lines),
        "broadcast": sum("BroadcastExchange" in x for x in lines),
        "python": sum("ArrowEvalPython" in x or "BatchEvalPython" in x or "FlatMapGroupsInPandas"
                      in x for x in lines),
    }


_BOUNDARIES = ("AdaptiveSparkPlan", "Exchange", "BroadcastExchange", "ShuffleQueryStage",
               "BroadcastQueryStage", "AQEShuffleRead", "ReusedExchange", "Subquery",
               "SubqueryBroadcast", "ReusedSubquery", "TableCacheQueryStage", "InputAdapter",
               "WholeStageCodegen", "ResultQueryStage")


def outside_codegen(plan: str) -> list[str]:
    """Operator names of an executed plan that run outside whole-stage codegen
    (stage boundaries — exchanges, query stages, subqueries — excluded)."""
    if "== Final Plan ==" in plan:  # executed adaptive plan: read the final section
        plan = plan.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    names = []
    for line in plan.splitlines():
        body = line.lstrip(" :+-|")
        if not body or body.startswith("*(") or body.startswith("== "):
            continue
        m = re.match(r"([A-Z][A-Za-z]+)", body)
        if m and not m.group(1).startswith(_BOUNDARIES):
            names.append(m.group(1))
    return sorted(set(names))


def codegen_report(spark, folder: str) -> None:
    from tillsight.registry import QUERIES
    print("| key | operators outside whole-stage codegen |")
    print("|---|---|")
    for key, q in QUERIES.items():
        df = q(spark, folder)
        df.collect()  # AQE inserts codegen stages at execution
        plan = df._jdf.queryExecution().executedPlan().toString()
        print(f"| {key} | {', '.join(outside_codegen(plan)) or '–'} |", flush=True)


def main() -> None:
    if "--codegen" in sys.argv:
        from tillsight.session import local_session
        args = [a for a in sys.argv[1:] if a != "--codegen"]
        codegen_report(local_session(8), args[0] if args else "/root/testdata/sf0.001")
        return
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    from tillsight.session import local_session
    spark = local_session(8)
    from tillsight.registry import QUERIES
    print("| key | shuffles | broadcasts | nested-loop | python | single-partition gathers |")
    print("|---|---|---|---|---|---|")
    for key, q in QUERIES.items():
        df = q(spark, folder)
        plan = df._jdf.queryExecution().executedPlan().toString()
        a = audit(plan)
        gathers = "; ".join(a["single"]) or "–"
        print(f"| {key} | {a['shuffles']} | {a['broadcast']} | {a['nested_loop']} | "
              f"{a['python']} | {gathers} |", flush=True)


if __name__ == "__main__":
    main()
