"""Benchmark: every registered query on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query's result is forced with the ``noop`` sink (full computation, no
collect).  After one warm-up pass, every query runs $BENCH_RUNS times and the
median is reported ($BENCH_SHUFFLE overrides the 2 x cores shuffle
partitions).  Prints ONE JSON line:

  {"metric": "total_median_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallyline.plans.catalog import QUERIES  # noqa: E402
from tallyline.session import build_session  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    only = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n]
    names = only or list(QUERIES)
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None

    shuffle = int(os.environ.get("BENCH_SHUFFLE", str(2 * cpus)))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=shuffle, app_name="tallyline-bench")

    def run(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    for n in names:          # warm-up: JIT, file listing caches, python workers
        run(n)
    times = {n: statistics.median(run(n) for _ in range(runs)) for n in names}
    spark.stop()
    print(json.dumps({
        "metric": "total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in times.items()},
        "sf": sf,
        "cpus": cpus,
        "runs": runs,
        "shuffle_partitions": shuffle,
    }))


if __name__ == "__main__":
    main()
