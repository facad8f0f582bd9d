"""Per-query task count and shuffle bytes from Spark's event log.

Usage: python tools/shuffle_report.py [sf_dir] [name ...]
The event log goes to a fresh folder under /tmp; the Spark UI stays off.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quantlake.plans.catalog import load_all  # noqa: E402
from quantlake.session import get_spark  # noqa: E402


def main() -> None:
    args = sys.argv[1:]
    sf = args[0] if args and args[0].startswith("/") else "/root/testdata/sf0.1"
    names = [a for a in args if not a.startswith("/")]
    logdir = tempfile.mkdtemp(prefix="run-eventlog-")
    spark = get_spark("local[8]", 8, extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": f"file://{logdir}",
                                                 "spark.eventLog.compress": "false"})
    reg = load_all()
    for n in names or list(reg):
        spark.sparkContext.setJobGroup(n, n)
        reg[n].fn(spark, sf).write.format("noop").mode("overwrite").save()
    spark.stop()
    stage_group, agg = {}, defaultdict(lambda: defaultdict(int))
    for path in sorted(p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(p)):
        with open(path) as f:
            for line in f:
                e = json.loads(line)
                ev = e.get("Event")
                if ev == "SparkListenerJobStart":
                    g = (e.get("Properties") or {}).get("spark.jobGroup.id")
                    for s in e.get("Stage IDs", []):
                        stage_group[s] = g
                elif ev == "SparkListenerTaskEnd":
                    g = stage_group.get(e.get("Stage ID"))
                    m = e.get("Task Metrics") or {}
                    a = agg[g]
                    a["tasks"] += 1
                    a["shuffle_write_bytes"] += (m.get("Shuffle Write Metrics") or {}).get("Shuffle Bytes Written", 0)
                    r = m.get("Shuffle Read Metrics") or {}
                    a["shuffle_read_bytes"] += r.get("Remote Bytes Read", 0) + r.get("Local Bytes Read", 0)
    print("| query | tasks | shuffle write MB | shuffle read MB |")
    print("| --- | --- | --- | --- |")
    for n in names or list(reg):
        a = agg.get(n, {})
        print(f"| {n} | {a.get('tasks', 0)} | "
              f"{a.get('shuffle_write_bytes', 0) / 2**20:.2f} | {a.get('shuffle_read_bytes', 0) / 2**20:.2f} |")


if __name__ == "__main__":
    main()
