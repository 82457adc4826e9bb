"""Per-query plan summary: shuffles, broadcasts, forbidden operators.

Usage: python tests/plan_report.py [sf_dir]
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def summary(df) -> dict:
    p = plan_text(df)
    return {"shuffles": len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|RoundRobin|SinglePartition)", p)),
            "broadcasts": p.count("BroadcastExchange"),
            "joins": len(re.findall(r"(BroadcastHashJoin|SortMergeJoin|ShuffledHashJoin)", p)),
            "forbidden": [f for f in FORBIDDEN if f in p]}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    import __spark_entry__ as E
    from hexflow.session import build_session
    spark = build_session()
    for name, fn in E.queries().items():
        print(f"{name:26s} {summary(fn(spark, sf_dir))}", flush=True)


if __name__ == "__main__":
    main(sys.argv)
