"""Benchmark the headline queries.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 3).  Each query is built fresh and executed fully with
Spark's ``noop`` sink (no driver collect), with the cache cleared before and
after, so nothing computed by one run is reused by the next; the reported time
is the median of the warm repeats.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from skylane.plans.contract import QUERIES  # noqa: E402
from skylane.session import local_session  # noqa: E402

HEADLINE = ["radar_in_terminal_area", "vertical_profile", "occupancy_first",
            "flight_consumption", "ml_features"]


def run_once(spark, name: str, sf_dir: str) -> float:
    spark.catalog.clearCache()  # no layer cached by an earlier run may be reused
    t = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    elapsed = time.perf_counter() - t
    spark.catalog.clearCache()
    return elapsed


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = local_session(cpus)
    run_once(spark, HEADLINE[-1], sf_dir)  # warm-up: JVM, code generation, file listing
    times = {}
    for name in HEADLINE:
        times[name] = round(statistics.median(run_once(spark, name, sf_dir)
                                              for _ in range(repeat)), 3)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "headline_queries_total_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
