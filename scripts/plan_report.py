"""Write PLANS.md: the shape of every catalog query's final (adaptive) physical plan.

usage: python scripts/plan_report.py [sf_dir] [out.md]

Each plan is executed once (into an RDD count, nothing collected) so adaptive
execution settles on its final plan; then shuffles, join strategies, windows,
Python nodes and cartesian products are counted from it.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cartwheel.plans.registry import load_all  # noqa: E402
from cartwheel.session import build_session  # noqa: E402

COUNTS = [
    ("shuffles", r"Exchange (hashpartitioning|rangepartitioning|RoundRobinPartitioning|SinglePartition)"),
    ("reused", r"ReusedExchange"),
    ("bcast_joins", r"BroadcastHashJoin"),
    ("smj", r"SortMergeJoin"),
    ("shj", r"ShuffledHashJoin"),
    ("windows", r"\bWindow \["),
    ("group_limit", r"WindowGroupLimit .* Partial"),
    ("top_k", r"TakeOrderedAndProject"),
    ("python", r"(ArrowEvalPython|BatchEvalPython|MapInPandas|FlatMapGroupsInPandas|MapInArrow)"),
    ("cartesian", r"(CartesianProduct|BroadcastNestedLoopJoin)"),
    ("single_part", r"Exchange SinglePartition"),
]


def final_plan(df) -> str:
    qe = df._jdf.queryExecution()
    plan = qe.executedPlan()
    plan.execute().count()
    text = plan.toString()
    # an executed adaptive plan prints its final and its initial form; keep the final
    return re.sub(r"\+- == Initial Plan ==.*?(?=\n\S|\Z)", "", text, flags=re.S)


def main(argv) -> int:
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    out = argv[2] if len(argv) > 2 else os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "PLANS.md")
    spark = build_session()
    rows = []
    for name, q in load_all().items():
        try:
            p = final_plan(q.fn(spark, sf))
            counts = [len(re.findall(rx, p)) for _, rx in COUNTS]
            scans = sorted(set(re.findall(r"Location: InMemoryFileIndex\(\d+ paths?\)\[[^\]]*/([a-z_]+)[-.]", p)))
            rows.append((name, ",".join(q.ops), counts, ", ".join(scans)))
        except Exception as e:  # keep going; report the failure
            rows.append((name, ",".join(q.ops), None, f"error: {type(e).__name__}"))
        print(name, file=sys.stderr, flush=True)
    head = ["query", "SURVEY rows"] + [c for c, _ in COUNTS] + ["reads"]
    lines = [
        "# PLANS",
        "",
        f"Final adaptive physical plans at `{sf}` (generated by `scripts/plan_report.py`). Columns count",
        "plan nodes: shuffles (Exchange), reused shuffles, broadcast / sort-merge / shuffled-hash joins,",
        "windows, partial WindowGroupLimit below a shuffle (top-N pushed before the exchange),",
        "TakeOrderedAndProject (distributed top-k), Python nodes, cartesian products, and shuffles to a",
        "single partition (global aggregates of one row, e.g. totals). Streaming queries show the plan",
        "that reads their sink back; their stream plans run inside the query. Join strategies are",
        "chosen at run time from sizes, so at larger scale broadcast joins become sort-merge joins.",
        "",
        "| " + " | ".join(head) + " |",
        "| " + " | ".join("---" for _ in head) + " |",
    ]
    for name, ops, counts, reads in rows:
        vals = [str(c) for c in counts] if counts else ["-"] * len(COUNTS)
        lines.append("| " + " | ".join([name, ops] + vals + [reads]) + " |")
    with open(out, "w") as f:
        f.write("\n".join(lines) + "\n")
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv))
