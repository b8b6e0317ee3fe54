"""Benchmark: run every catalogue query on $BENCH_SF_DIR and print one JSON line.

Each query is executed end to end with the ``noop`` sink (the whole plan runs, no
rows are shipped to the driver). A warm-up query runs first so JVM start-up and
code loading are not charged to the first entry.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_REPEAT (default 2; the best of N runs is reported per query -- the first
run of a query also pays Janino code generation and JIT warm-up, which large inputs
amortise; the cold first-run total is reported as well, as ``cold_value``),
BENCH_ONLY (comma-separated query names), BENCH_SHUFFLE_PARTITIONS (default: cpus;
AQE coalesces what is too small).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = max(1, int(os.environ.get("BENCH_REPEAT", "2")))
    only = [q for q in os.environ.get("BENCH_ONLY", "").split(",") if q]

    from casebook.session import get_session
    from casebook.catalog import QUERIES

    partitions = int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", str(cpus)))
    spark = get_session(f"local[{cpus}]", app="casebook-bench", shuffle_partitions=partitions,
                        extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
                               "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024)})

    # warm-up (not timed)
    QUERIES["customer_count"](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    cold: dict[str, float] = {}
    errors: dict[str, str] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        best = None
        try:
            for i in range(repeat):
                t0 = time.perf_counter()
                fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
                dt = time.perf_counter() - t0
                if i == 0:
                    cold[name] = dt
                best = dt if best is None else min(best, dt)
        except Exception as e:  # noqa: BLE001 - recorded, the other queries still run
            errors[name] = str(e).splitlines()[0][:300]
            continue
        times[name] = round(best, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_query_seconds",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "n_queries": len(times),
        "cold_value": round(sum(cold.values()), 3),
        "repeat": repeat,
        "cpus": cpus,
        "errors": errors,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
