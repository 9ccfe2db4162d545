"""Summarise the physical plans of registered queries (markdown).

``python -m jobsheet.plans.inspect [names] [--sf=DIR]`` prints, per query,
the number of shuffles, broadcasts, joins, windows and aggregations in the
(initial, pre-AQE) physical plan and the columns each parquet scan reads,
so the scale review can be repeated after every change.
"""

from __future__ import annotations

import re
import sys
from collections import Counter

OPS = ("Exchange hashpartitioning", "Exchange rangepartitioning", "Exchange SinglePartition", "BroadcastExchange",
       "SortMergeJoin", "BroadcastHashJoin", "BroadcastNestedLoopJoin", "CartesianProduct", "HashAggregate",
       "ObjectHashAggregate", "SortAggregate", "Window", "Generate", "BatchEvalPython", "ArrowEvalPython")


def summarise(df) -> tuple[Counter, list[str]]:
    plan = df._jdf.queryExecution().executedPlan().toString()
    c = Counter()
    for line in plan.splitlines():
        s = line.strip().lstrip(":+- ").strip()
        for op in OPS:
            if s.startswith(op):
                c[op] += 1
    scans = []
    for m in re.finditer(r"FileScan parquet [^\[]*\[([^\]]*)\].*?Location: [^\[]*\[([^\]]*)\]", plan):
        cols, loc = m.group(1), m.group(2)
        table = loc.rstrip("/").split("/")[-1].replace(".parquet", "")
        scans.append(f"{table}({', '.join(c.split('#')[0].strip() for c in cols.split(','))})")
    return c, sorted(set(scans))


def main(argv=None):
    argv = argv if argv is not None else sys.argv[1:]
    sf = "/root/testdata/sf0.1"
    names = [a for a in argv if not a.startswith("--")]
    for a in argv:
        if a.startswith("--sf="):
            sf = a.split("=", 1)[1]
    from jobsheet.plans import catalog  # noqa: F401
    from jobsheet.plans.registry import REGISTRY
    from jobsheet.session import local_session
    spark = local_session(8)
    names = names or list(REGISTRY)
    print("| query | hash shuffles | range shuffles | broadcasts | SMJ | BHJ | aggregates | windows | python | scans (columns read) |")
    print("|---|---|---|---|---|---|---|---|---|---|")
    for n in names:
        try:
            c, scans = summarise(REGISTRY[n].fn(spark, sf))
        except Exception as ex:  # report and continue
            print(f"| {n} | error: {type(ex).__name__} |||||||||")
            continue
        aggs = c["HashAggregate"] + c["ObjectHashAggregate"] + c["SortAggregate"]
        py = c["BatchEvalPython"] + c["ArrowEvalPython"]
        print(f"| {n} | {c['Exchange hashpartitioning']} | {c['Exchange rangepartitioning']} | {c['BroadcastExchange']} "
              f"| {c['SortMergeJoin']} | {c['BroadcastHashJoin']} | {aggs} | {c['Window']} | {py} | "
              f"{'; '.join(scans)} |", flush=True)


if __name__ == "__main__":
    main()
