"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line: {"metric", "value" (sum of medians), "unit", "queries", "sf"}.
Each query is run once to warm up, then timed ``BENCH_REPS`` times (median);
results are consumed with the ``noop`` sink so the whole plan executes.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quern.session import get_session  # noqa: E402
from quern.plans import REGISTRY  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [a for a in sys.argv[1:]]
    spark = get_session(f"local[{cpus}]", app="quern-bench",
                        conf={"spark.sql.shuffle.partitions": str(int(cpus) * 2),
                              "spark.driver.memory": "16g"})
    names = [n for n, q in REGISTRY.items() if q.bench and (not only or n in only)]
    timings: dict[str, float] = {}
    for name in names:
        fn = REGISTRY[name].fn
        runs = []
        for i in range(reps + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i:
                runs.append(time.perf_counter() - t0)
        timings[name] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "sum_of_median_query_seconds",
                      "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": sf}))


if __name__ == "__main__":
    main()
