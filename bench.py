"""Benchmark: the library's queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query runs to completion through the ``noop`` sink (full execution, nothing collected),
once to warm up and then up to ``$BENCH_REPEAT`` times (fewer where that takes over 10 s); the
median is reported, and the smallest and largest time as the spread. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from boxstats.plans import queries as Q  # noqa: E402
from boxstats.session import build_session  # noqa: E402

def run_once(spark, fn, sf_dir: str) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q] or list(Q.QUERIES)
    shuffle = int(os.environ.get("BENCH_SHUFFLE", str(max(cpus * 2, 8))))
    spark = build_session(f"local[{cpus}]", shuffle_partitions=shuffle,
                          app_name="boxstats-bench",
                          extra={"spark.driver.memory": os.environ.get("BENCH_MEM", "16g")})
    times, spread = {}, {}
    for name in only:
        fn = Q.QUERIES[name]
        run_once(spark, fn, sf_dir)
        runs: list[float] = []
        while len(runs) < repeat and (not runs or sum(runs) < 10):
            runs.append(run_once(spark, fn, sf_dir))
        times[name] = round(statistics.median(runs), 3)
        spread[name] = [round(min(runs), 3), round(max(runs), 3)]
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_median_sec", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus,
                      "repeat": repeat, "spread": spread}))


if __name__ == "__main__":
    main()
