"""Summarise the executed (AQE-final) physical plans of the headline queries,
and all jobs and stages they run, those of eager steps (checkpoints, totals) included.

    python tools/plan_report.py [sf_dir] > PLANS.md
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

COUNT = {
    "shuffles": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition|Exchange RoundRobin",
    "single-partition exchanges": r"Exchange SinglePartition",
    "broadcast joins": r"BroadcastHashJoin|BroadcastNestedLoopJoin",
    "sort-merge joins": r"SortMergeJoin",
    "shuffled hash joins": r"ShuffledHashJoin",
    "windows": r"\bWindow\b",
    "python (pandas) nodes": r"FlatMapGroupsInPandas|ArrowEvalPython|MapInPandas",
    "scans": r"FileScan|Scan parquet|Scan ExistingRDD",
}


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from bench import HEADLINE
    from tillwise.catalog import REGISTRY
    from tillwise.session import get_session
    spark = get_session("local[8]", shuffle_partitions=8)
    print("# Physical plans of the headline queries\n")
    print(f"Executed AQE plans at `{sf_dir}` (local[8]); counts are plan nodes of the final query "
          "(checkpointed inputs appear as `Scan ExistingRDD`).\n")
    print("| query | jobs, eager ones included | stages of all jobs | " + " | ".join(COUNT) + " |")
    print("| --- | --- | --- |" + " --- |" * len(COUNT))
    tracker = spark.sparkContext.statusTracker()
    for key in HEADLINE:
        spark.sparkContext.setJobGroup(key, key)
        df = REGISTRY[key].build(spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        plan = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        cells = [str(len(re.findall(p, plan))) for p in COUNT.values()]
        jobs = tracker.getJobIdsForGroup(key)
        stages = {x for j in jobs if (info := tracker.getJobInfo(j)) for x in info.stageIds}
        print(f"| {key} | {len(jobs)} | {len(stages)} | " + " | ".join(cells) + " |")


if __name__ == "__main__":
    main()
