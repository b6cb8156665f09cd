"""Plan report for the registered queries.

``python -m corpusqa.plans.report [sf_dir] [name,...]`` prints, per query,
the physical-plan node counts that matter at scale: shuffles, join kinds,
Python (Arrow) stages, partial top-k, and the columns each scan reads.
The plan is the initial adaptive plan; nothing is executed except the small
actions some queries run while they are built.
"""

from __future__ import annotations

import re
import sys

NODES = {
    "shuffles": r"Exchange hashpartitioning|Exchange RoundRobinPartitioning|Exchange rangepartitioning|Exchange SinglePartition",
    "broadcasts": r"BroadcastExchange",
    "broadcast_joins": r"BroadcastHashJoin",
    "sort_merge_joins": r"SortMergeJoin",
    "cross_products": r"CartesianProduct|BroadcastNestedLoopJoin",
    "python_stages": r"ArrowEvalPython|MapInArrow|MapInPandas|PythonMapInArrow",
    "partial_topk": r"WindowGroupLimit .* Partial",
}


def plan_stats(df) -> dict:
    plan = df._jdf.queryExecution().executedPlan().toString()
    stats = {k: len(re.findall(v, plan)) for k, v in NODES.items()}
    stats["read_schemas"] = sorted(set(re.findall(r"ReadSchema: (struct<[^>]*>)", plan)))
    return stats


def main(argv=None) -> None:
    argv = list(sys.argv[1:] if argv is None else argv)
    sf = argv[0] if argv else "/root/testdata/sf0.001"
    import os

    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from corpusqa.plans import driver_queries as dq
    from corpusqa.session import get_spark

    names = argv[1].split(",") if len(argv) > 1 else list(dq.QUERIES)
    spark = get_spark("local[4]", **{"spark.ui.showConsoleProgress": "false"})
    for name in names:
        s = plan_stats(dq.make(name)(spark, sf))
        schemas = "; ".join(x[:70] for x in s.pop("read_schemas"))
        print(name, " ".join(f"{k}={v}" for k, v in s.items()), "|", schemas)


if __name__ == "__main__":
    main()
