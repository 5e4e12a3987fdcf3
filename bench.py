"""Benchmark: load the binding through the pipeline, then run every
registered query; print one JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_EVENT_LOG_DIR (optional: write the Spark event log there),
     BENCH_QUERIES (comma-separated subset, optional).
Each query is fully evaluated with the ``noop`` sink (nothing is collected
to the driver).
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from metamart.plans import catalog  # noqa: E402
from metamart.session import get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    extra = {"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g")}
    if os.environ.get("BENCH_EVENT_LOG_DIR"):        # stage/task times, read offline
        extra.update({"spark.eventLog.enabled": "true", "spark.eventLog.dir": os.environ["BENCH_EVENT_LOG_DIR"]})
    spark = get_spark(f"local[{cpus}]", app="metamart-bench", shuffle_partitions=cpus, extra=extra)
    times: dict[str, float] = {}
    # JVM start-up and JIT warm-up are not query work: one small untimed job
    spark.range(1_000_000).selectExpr("sum(id) AS s", "count(DISTINCT id % 97) AS d").collect()

    t0 = time.perf_counter()
    catalog.loaded(spark, sf_dir)            # ingest, validate, publish gold
    times["warehouse_load"] = round(time.perf_counter() - t0, 3)

    for name, q in catalog.QUERIES.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        q(spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)", sf_dir)
    print(json.dumps({
        "metric": "total_seconds_load_plus_all_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
