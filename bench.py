"""Benchmark the registered queries; prints ONE JSON line.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default: all reference queries), BENCH_RUNS (default 2),
BENCH_SECONDS (default 1500: queries that begin later are run once, so the line is printed).

Each query is built and run once (``cold``: nothing is shared between queries,
so this is all its work, code generation included) and then BENCH_RUNS times
more; ``queries`` has the median of those. Each query's times go to stderr as it ends. Execution uses the ``noop`` sink, so
the whole plan runs on the executors and nothing is pulled to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pacekit.plans.queries import REGISTRY  # noqa: E402
from pacekit.session import build_session  # noqa: E402


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(REGISTRY)
    spark = build_session(f"local[{cpus}]", shuffle_partitions=cpus,
                          extra={"spark.driver.memory": "8g"})
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    cold, times = {}, {}
    late = time.perf_counter() + float(os.environ.get("BENCH_SECONDS", "1500"))
    for n in names:
        took = []
        for _ in range(runs + 1 if time.perf_counter() < late else 1):
            t0 = time.perf_counter()
            run(REGISTRY[n](spark, sf_dir))
            took.append(round(time.perf_counter() - t0, 3))
        cold[n], times[n] = took[0], round(statistics.median(took[1:] or took), 3)
        print(f"{n}: cold {cold[n]}, median {times[n]}", file=sys.stderr, flush=True)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cold": cold}))


if __name__ == "__main__":
    main()
