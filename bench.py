"""Benchmark: run every registered query at $BENCH_SF_DIR on
local[$BENCH_CPUS] and print one JSON line.

Each query is executed in full with Spark's ``noop`` sink (the whole plan
runs, nothing is collected to the driver).  ``value`` is the sum of the
per-query wall-clock seconds.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]

    from squall.plans import queries
    from squall.session import get_session

    scratch = tempfile.mkdtemp(prefix="squall-bench-")
    spark = get_session(f"local[{cpus}]", app_name="squall-bench",
                        shuffle_partitions=int(cpus) * 2,
                        extra_conf={"spark.driver.memory": "16g",
                                    "spark.checkpoint.dir": f"{scratch}/checkpoints",
                                    "spark.sql.files.maxPartitionBytes": "64m"})
    qs = queries()
    names = only or sorted(qs)
    # JVM warm-up (class loading, code generation paths) on the smallest
    # data set when present, so no measured input is cached beforehand
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    for name in ("classify_obs", "records_by_city", "stream_win_city"):
        qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times, errors = {}, {}
    for name in names:
        t0 = time.perf_counter()
        try:
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as exc:  # noqa: BLE001 - report and continue
            errors[name] = f"{type(exc).__name__}: {str(exc)[:200]}"
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    out = {"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
           "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus),
           "n_queries": len(times)}
    if errors:
        out["errors"] = errors
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
