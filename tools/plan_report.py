"""Summarise the physical plan of every registered query.

Usage: python tools/plan_report.py [--stored] [sf_dir] [name ...]
``--stored`` first stores the derived annotation tables as parquet (as the
bench does), so the plans show the operators rather than the derivation.
Prints per query: number of shuffles, joins by strategy, single-partition
exchanges, Python evaluation nodes, top-k nodes and scans.
"""

from __future__ import annotations

import re
import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from mentions.plans import load_all  # noqa: E402
from mentions.session import local_session  # noqa: E402

MARKERS = ["BroadcastNestedLoopJoin", "CartesianProduct", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas",
           "MapInPandas", "TakeOrderedAndProject", "SortMergeJoin", "BroadcastHashJoin", "ShuffledHashJoin",
           "Window", "Generate", "Expand"]


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def main(argv):
    stored = "--stored" in argv
    argv = [a for a in argv if a != "--stored"]
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.01"
    only = set(argv[2:])
    spark = local_session(8)
    if stored:
        from mentions.plans.flatten_queries import materialize_nested
        from mentions.session import scratch_dir
        from mentions.sources.views import materialize

        folder = scratch_dir(spark, "plan-report")
        materialize(spark, sf_dir, folder)
        materialize_nested(spark, sf_dir, folder)
    for name, q in load_all().items():
        if only and name not in only:
            continue
        if name.startswith(("stream_", "json_", "append_", "presence_", "rewrite_", "csv_")) or name.endswith("round_trip"):
            continue  # these run jobs while building their result
        df = q.fn(spark, sf_dir)
        df._jdf.queryExecution().executedPlan()  # force planning
        text = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        counts = {m: len(re.findall(rf"\b{m}\b", text.split("\n\n")[0])) for m in MARKERS}
        shuffles = len(re.findall(r"^\(\d+\) Exchange", text, re.M))
        single = len(re.findall(r"Arguments: SinglePartition", text))
        subq = len(re.findall(r"^Subquery:\d+", text, re.M))
        flags = {k: v for k, v in counts.items() if v}
        print(f"{name}: exchanges={shuffles} single_partition={single} subqueries={subq} {flags}")


if __name__ == "__main__":
    main(sys.argv)
