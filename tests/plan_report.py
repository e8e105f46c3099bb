"""Summarise the physical plans of the headline queries as a Markdown table.

Usage: python -m tests.plan_report [sf_dir] > PLANS.md
Counts come from the executed (adaptive, final) plan after running the query.
"""

from __future__ import annotations

import re
import sys


def summarise(df) -> dict:
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    scans = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    return {
        "shuffles": len(re.findall(r"Exchange (hash|range|Single|RoundRobin)", plan)),
        "broadcast_joins": plan.count("BroadcastHashJoin"),
        "sort_merge_joins": plan.count("SortMergeJoin"),
        "windows": len(re.findall(r"\bWindow\b", plan)),
        "python": len(re.findall(r"MapInPandas|ArrowEvalPython|BatchEvalPython", plan)),
        "scan_columns": ",".join(str(len(s.split(","))) for s in scans),
        "pushed": "yes" if "PushedFilters: [" in plan and "PushedFilters: []" not in plan else "",
    }


def main(argv):
    sf = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    sys.path.insert(0, ".")
    import bench
    import __spark_entry__ as E
    from fraudspark.session import local_session
    spark = local_session()
    qs = E.queries()
    print("| Query | Shuffles | Broadcast joins | Sort-merge joins | Windows | Python stages | Columns read per scan | Filters pushed |")
    print("|---|---|---|---|---|---|---|---|")
    for name in bench.HEADLINE:
        s = summarise(qs[name](spark, sf))
        print(f"| `{name}` | {s['shuffles']} | {s['broadcast_joins']} | {s['sort_merge_joins']} | {s['windows']} | "
              f"{s['python']} | {s['scan_columns']} | {s['pushed']} |")


if __name__ == "__main__":
    main(sys.argv)
