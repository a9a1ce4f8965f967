"""Benchmark the headline queries.

Runs each query on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]``: one warm-up, then the median of ``$BENCH_REPS``
(default 3) timed runs into the ``noop`` sink (full execution, no output).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("detect", "yoy_baseline", "rolling_baseline", "backtest_daily", "snapshot_detect", "digest")


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    names = [n for n in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if n]
    from metricwatch.session import local_session
    from metricwatch.queries import REGISTRY

    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", 2 * int(cpus))),
                          app="metricwatch-bench")
    spark.sparkContext.setLogLevel("ERROR")
    out = {}
    for n in names:
        run = lambda: REGISTRY[n](spark, sf_dir).write.format("noop").mode("overwrite").save()
        run()  # warm-up
        times = []
        for _ in range(reps):
            t0 = time.perf_counter()
            run()
            times.append(time.perf_counter() - t0)
        out[n] = round(statistics.median(times), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({"metric": "sum_of_median_query_seconds", "value": round(sum(out.values()), 3), "unit": "sec",
                      "queries": out, "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}))


if __name__ == "__main__":
    main()
