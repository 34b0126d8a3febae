"""Operator counts of the executed plan of registered queries.

    python tools/plan_summary.py sf_dir name ...
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

INTERESTING = ("FileScan", "Exchange hashpartitioning", "Exchange rangepartitioning",
               "Exchange SinglePartition", "Exchange RoundRobin", "BroadcastExchange",
               "ReusedExchange", "SortMergeJoin", "ShuffledHashJoin", "BroadcastHashJoin",
               "BroadcastNestedLoopJoin", "CartesianProduct", "WindowGroupLimit", "Window ",
               "Expand", "Generate", "SortAggregate", "ObjectHashAggregate", "HashAggregate",
               "Scan ExistingRDD", "PythonUDF", "TakeOrderedAndProject")


def main(argv):
    from cadastre.plans.registered import QUERIES
    from cadastre.session import build_session
    spark = build_session("local[8]", shuffle_partitions=8, **{
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    sf_dir, show = argv[0], "--plan" in argv
    for name in [a for a in argv[1:] if a != "--plan"]:
        frame = QUERIES[name](spark, sf_dir)
        frame.collect()
        text = frame._jdf.queryExecution().executedPlan().toString()
        text = text.split("== Initial Plan ==")[0]
        counts = {k: len(re.findall(re.escape(k), text)) for k in INTERESTING}
        print(name, {k: v for k, v in counts.items() if v}, flush=True)
        if show:
            print(text)


if __name__ == "__main__":
    main(sys.argv[1:])
