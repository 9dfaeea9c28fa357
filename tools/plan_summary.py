"""Run every query and summarise its executed (AQE-final) physical plan:
shuffles, broadcasts, join strategies, aggregates, subqueries. Writes PLANS.md.

usage: python tools/plan_summary.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys
from collections import Counter

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from linebeam.plans.queries import QUERIES  # noqa: E402
from linebeam.session import build_session  # noqa: E402

WATCH = ["Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange RoundRobinPartitioning",
         "Exchange SinglePartition", "BroadcastExchange", "ReusedExchange", "BroadcastHashJoin",
         "SortMergeJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "Generate", "partial_",
         "ObjectHashAggregate", "Subquery", "CollectMetrics", "skew=true"]


def indent(line: str) -> int:
    m = re.search(r"[A-Za-z*]", line)
    return m.start() if m else 0


def final_lines(lines: list[str]) -> list[str]:
    """Lines of an adaptive plan block without its ``Initial Plan`` part."""
    out, skip_at = [], None
    for line in lines:
        if "== Initial Plan ==" in line:
            skip_at = indent(line)
            continue
        if skip_at is not None:
            if indent(line) > skip_at:
                continue
            skip_at = None
        out.append(line)
    return out


def count(lines, target: Counter):
    for line in lines:
        for w in WATCH:
            if w in line:
                target[w] += line.count(w) if w == "partial_" else 1


def summarise(plan: str) -> tuple[Counter, Counter, int]:
    """(main-plan counts, subquery counts, distinct subqueries) of a final
    physical plan string; a subquery referenced several times is executed
    once and counted once."""
    main, sub, seen = Counter(), Counter(), set()
    lines = final_lines(plan.splitlines())
    i = 0
    while i < len(lines):
        line = lines[i]
        m = re.match(r"^[\s:|+\-]*(?:Subquery|ReusedSubquery) subquery#(\d+)", line)
        if m:
            lvl, block = indent(line), []
            i += 1
            while i < len(lines) and indent(lines[i]) > lvl:
                block.append(lines[i])
                i += 1
            if m.group(1) not in seen:
                seen.add(m.group(1))
                count(final_lines(block), sub)
            continue
        count([line], main)
        i += 1
    return main, sub, len(seen)


def main():
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = build_session()
    out = ["# Executed plans", "",
           f"Generated by `tools/plan_summary.py` at `{sf}` on local[8]: counts of plan nodes in each",
           "reference-side query's AQE-final physical plan. Counts are for the main plan; a scalar",
           "subquery (Bloom bits, hash set of the hot keys) runs once per query as its own small job,",
           "and staged side tables (hot keys, filters) are read from files.", "",
           "| query | hash shuffles | range | single | round-robin | broadcast | BHJ | SMJ | NLJ/cartesian | partial aggs | scalar subquery |",
           "|---|---|---|---|---|---|---|---|---|---|---|"]
    for name, fn in QUERIES.items():
        df = fn(spark, sf)
        df.collect()
        node = df._jdf.queryExecution().executedPlan()
        try:
            plan = node.executedPlan().toString()  # the final plan of an adaptive query
        except Exception:  # noqa: BLE001 - no adaptive node (no exchange, no subquery)
            plan = node.toString()
        c, sq, nsub = summarise(plan)
        out.append(f"| `{name}` | {c['Exchange hashpartitioning']} | {c['Exchange rangepartitioning']} | "
                   f"{c['Exchange SinglePartition']} | {c['Exchange RoundRobinPartitioning']} | "
                   f"{c['BroadcastExchange']} | {c['BroadcastHashJoin']} | {c['SortMergeJoin']} | "
                   f"{c['BroadcastNestedLoopJoin'] + c['CartesianProduct']} | {c['partial_']} | "
                   f"{'yes' if nsub else ''} |")
        print(out[-1], flush=True)
    with open(os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md"), "w") as fh:
        fh.write("\n".join(out) + "\n")


if __name__ == "__main__":
    main()
