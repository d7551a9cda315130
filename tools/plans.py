"""Summarise the final (adaptive) physical plan of every registered query.

usage: python tools/plans.py [sf_dir] [--markdown] [key ...]

Each query is executed once (collect) so that AQE's runtime decisions
(broadcast vs shuffle joins, coalesced partitions) are in the plan that is
summarised.
"""

from __future__ import annotations

import io
import os
import re
import sys
from contextlib import redirect_stdout

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

OPS = ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition",
       "BroadcastExchange", "ReusedExchange", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
       "HashAggregate", "SortAggregate", "ObjectHashAggregate", "Window ", "WindowGroupLimit", "Generate",
       "BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython")
SHORT = {"Exchange hashpartitioning": "hash-shuffle", "Exchange rangepartitioning": "range-shuffle",
         "Exchange SinglePartition": "single", "BroadcastExchange": "bcast", "ReusedExchange": "reused",
         "SortMergeJoin": "SMJ", "BroadcastHashJoin": "BHJ", "ShuffledHashJoin": "SHJ",
         "HashAggregate": "HashAgg", "SortAggregate": "SortAgg", "ObjectHashAggregate": "ObjAgg",
         "Window ": "Window", "WindowGroupLimit": "WGLimit", "Generate": "Generate",
         "BroadcastNestedLoopJoin": "BNLJ", "CartesianProduct": "Cartesian", "BatchEvalPython": "PyUDF",
         "ArrowEvalPython": "PandasUDF"}


def final_plan(df) -> str:
    df.collect()
    buf = io.StringIO()
    with redirect_stdout(buf):
        df.explain()
    text = buf.getvalue()
    m = re.search(r"\+- == Final Plan ==(.*?)\+- == Initial Plan ==", text, re.S)
    return m.group(1) if m else text


def summarise(plan: str) -> dict:
    counts = {SHORT[op]: len(re.findall(re.escape(op), plan)) for op in OPS}
    counts = {k: v for k, v in counts.items() if v}
    pushed = sorted({p for p in re.findall(r"PushedFilters: \[([^\]]*)\]", plan) if p})
    return {"ops": counts, "pushed": pushed}


def main():
    args = sys.argv[1:]
    sf = next((a for a in args if a.startswith("/")), "/root/testdata/sf0.01")
    md = "--markdown" in args
    keys = [a for a in args if not a.startswith("/") and not a.startswith("--")]
    from quayside.session import build_session
    from quayside.plans.registry import all_queries

    spark = build_session()
    qs = all_queries()
    if md:
        print("| query | final-plan operators | pushed filters (sample) |")
        print("|---|---|---|")
    for k in keys or sorted(qs):
        s = summarise(final_plan(qs[k](spark, sf)))
        ops = ", ".join(f"{n} {c}" for n, c in s["ops"].items())
        pushed = "; ".join(p[:60] for p in s["pushed"][:2])
        print(f"| `{k}` | {ops} | {pushed} |" if md else f"== {k}: {ops} | pushed: {pushed}")


if __name__ == "__main__":
    main()
