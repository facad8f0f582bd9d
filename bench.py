"""Benchmark: time every registered query on $BENCH_SF_DIR with local[$BENCH_CPUS].

Each query is executed in full with the ``noop`` sink (every row produced,
nothing collected to the driver).  Prints one JSON line:
{"metric": "total_query_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from quantlake.plans.catalog import load_all  # noqa: E402
from quantlake.session import clear_scratch, get_spark  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = [a for a in sys.argv[1:]]
    m = re.search(r"sf([0-9.]+)", sf_dir)
    sf = float(m.group(1)) if m else None
    spark = get_spark(f"local[{cpus}]", partitions=int(cpus), app="quantlake-bench", driver_memory="16g")
    reg = load_all()
    # warm the JVM and file listing once, untimed
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").write.format("noop").mode("overwrite").save()
    times, failed = {}, {}
    for name, q in reg.items():
        if only and name not in only:
            continue
        t0 = time.perf_counter()
        try:
            q.fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
        except Exception as e:  # noqa: BLE001
            failed[name] = f"{type(e).__name__}: {str(e)[:200]}"
        clear_scratch(spark)                      # untimed
    out = {"metric": "total_query_sec", "value": round(sum(times.values()), 3), "unit": "sec",
           "queries": times, "sf": sf, "n_queries": len(times)}
    if failed:
        out["failed"] = failed
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
