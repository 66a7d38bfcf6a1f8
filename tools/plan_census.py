"""Plan census: how every registered query would execute on large tables.

Plans each query with size-based broadcasting off (as when every table is
far above the threshold) and counts what remains: shuffles, sort-merge
joins, broadcasts that are explicit and bounded, windows, Python stages and
partial aggregates. Prints a Markdown table.

    python tools/plan_census.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def census(plan: str) -> dict:
    return {
        "shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan)),
        "smj": plan.count("SortMergeJoin"),
        "bcast": plan.count("BroadcastExchange"),
        "window": len(re.findall(r"\bWindow\b", plan)),
        "python": len(re.findall(r"MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMapGroupsInPandas", plan)),
        "partial_agg": len(re.findall(r"partial_", plan)),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    from starloom.plans.driver_tables import QUERIES
    from starloom.session import build_session
    spark = build_session(shuffle_partitions=8, extra={
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"})
    print("| query | shuffles | sort-merge joins | bounded broadcasts | windows | Python stages | partial aggs |")
    print("| --- | --- | --- | --- | --- | --- | --- |")
    for key in sorted(QUERIES):
        df = QUERIES[key](spark, sf_dir)
        c = census(df._jdf.queryExecution().executedPlan().toString())
        print(f"| `{key}` | {c['shuffles']} | {c['smj']} | {c['bcast']} | {c['window']} | "
              f"{c['python']} | {c['partial_agg']} |")


if __name__ == "__main__":
    main()
