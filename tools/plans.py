"""Print, per registered query, what its physical plan holds that would hurt at scale."""

import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(__file__), ".."))

from tidewright.plans import catalog  # noqa: E402
from tidewright.session import local_session  # noqa: E402

MARKS = ["CartesianProduct", "BroadcastNestedLoopJoin", "SinglePartition", "BatchEvalPython", "ArrowEvalPython"]


def main():
    spark = local_session()
    for name, run in catalog.spark_queries().items():
        if sys.argv[1:] and not any(name.startswith(p) for p in sys.argv[1:]):
            continue
        plan = run(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        found = {m: plan.count(m) for m in MARKS if m in plan}
        windows = plan.count("Window [")
        print(name, found, "windows", windows, "exchanges", plan.count("Exchange hashpartitioning"), flush=True)


main()
