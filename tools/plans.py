"""Execute queries and summarise their final (AQE) physical plans.

usage: python tools/plans.py [sf_dir] [name ...]   (default: the bench headline queries at sf0.01)
Prints per query the count of shuffles, sorts, windows, joins by strategy and reused exchanges;
``PLAN_DIR=/some/dir`` also writes each formatted plan there.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, __file__.rsplit("/tools/", 1)[0])

PATTERNS = {
    "shuffle": r"Exchange hashpartitioning|Exchange rangepartitioning|Exchange SinglePartition",
    "broadcast": r"BroadcastExchange",
    "reused": r"ReusedExchange",
    "sort": r"\bSort \[",
    "window": r"\bWindow \[",
    "smj": r"SortMergeJoin",
    "bhj": r"BroadcastHashJoin",
    "bnlj_or_cartesian": r"BroadcastNestedLoopJoin|CartesianProduct",
    "python_udf": r"BatchEvalPython|ArrowEvalPython|FlatMapGroupsInPandas|MapInPandas",
}


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 and "/" in argv[1] else "/root/testdata/sf0.01"
    names = [a for a in argv[1:] if "/" not in a] or ["detect", "yoy_baseline", "rolling_baseline", "backtest_daily",
                                                        "snapshot_detect", "digest"]
    from metricwatch.queries import REGISTRY
    from metricwatch.session import local_session
    spark = local_session(8)
    spark.sparkContext.setLogLevel("ERROR")
    out_dir = os.environ.get("PLAN_DIR")
    for n in names:
        df = REGISTRY[n](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        plan = df._jdf.queryExecution().executedPlan().toString()
        counts = {k: len(re.findall(p, plan)) for k, p in PATTERNS.items()}
        print(f"{n:22s} " + " ".join(f"{k}={v}" for k, v in counts.items()))
        if out_dir:
            os.makedirs(out_dir, exist_ok=True)
            with open(os.path.join(out_dir, f"{n}.txt"), "w") as f:
                f.write(plan)


if __name__ == "__main__":
    main(sys.argv)
