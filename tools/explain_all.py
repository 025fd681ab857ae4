"""Summarise the physical plan of every catalogue query (writes PLANS.md).

    python tools/explain_all.py [sf_dir] > PLANS.md

Per query: number of file scans and how many carry partition filters / pushed filters,
join strategies, shuffle exchanges, broadcast exchanges, window group limits, and
whether any Python evaluation node appears. Plans are the adaptive plans before
execution (AQE may still coalesce partitions or switch joins at run time).
"""

from __future__ import annotations

import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

from topiclake.plans.catalog import QUERIES  # noqa: E402
from topiclake.session import get_spark  # noqa: E402


def summarise(plan: str) -> dict:
    scans = plan.count("FileScan parquet") + plan.count("BatchScan parquet")
    return {
        "scans": scans,
        "partition_filtered": len(re.findall(r"PartitionFilters: \[[^\]]+\]", plan)),
        "pushed": len(re.findall(r"PushedFilters: \[[^\]]+\]", plan)),
        "joins": sorted(set(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin|BroadcastNestedLoopJoin|"
                                       r"CartesianProduct)", plan))),
        "exchanges": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)",
                                    plan)),
        "broadcasts": plan.count("BroadcastExchange"),
        "group_limit": "WindowGroupLimit" in plan,
        "python": any(x in plan for x in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
                                          "MapInPandas")),
    }


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    spark = get_spark("local[8]", shuffle_partitions=8)
    spark.sparkContext.setLogLevel("ERROR")
    print("# Physical plan summary\n")
    print(f"Generated by `tools/explain_all.py` at `{sf_dir}` (Spark {spark.version}). Counts are of the "
          "executed-plan text before adaptive re-planning; `pf` = scans with partition filters, "
          "`pushed` = scans with filters pushed into Parquet.\n")
    print("| query | scans | pf | pushed | joins | shuffles | broadcasts | group limit | python |")
    print("|---|---|---|---|---|---|---|---|---|")
    for name, fn in QUERIES.items():
        df = fn(spark, sf_dir)
        plan = df._jdf.queryExecution().executedPlan().toString()
        s = summarise(plan)
        print(f"| `{name}` | {s['scans']} | {s['partition_filtered']} | {s['pushed']} | "
              f"{', '.join(s['joins']) or '–'} | {s['exchanges']} | {s['broadcasts']} | "
              f"{'yes' if s['group_limit'] else ''} | {'yes' if s['python'] else ''} |")


if __name__ == "__main__":
    main()
