"""Skew rehearsal: one user holds a third of ``events``; how much lands on the busiest task?

Runs the previous-value scan (W8) with month, day and auto buckets and reports,
from Spark's event log, the largest share of shuffle records read by one task.
Usage: python tools/skew_check.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile
from collections import defaultdict

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from quantlake.operators.panel import lagged  # noqa: E402
from quantlake.operators.scan import auto_grain, time_bucket  # noqa: E402
from quantlake.session import get_spark  # noqa: E402


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    logdir = tempfile.mkdtemp(prefix="run-skew-")
    spark = get_spark("local[8]", 32, extra={"spark.eventLog.enabled": "true", "spark.eventLog.compress": "false",
                                             "spark.eventLog.dir": f"file://{logdir}",
                                             "spark.sql.adaptive.enabled": "false"})
    ev = spark.read.parquet(f"{sf}/events.parquet")
    # a third of all rows moved onto user 0
    hot = ev.withColumn("user_id", F.when(F.col("event_id") % 3 == 0, F.lit(0)).otherwise(F.col("user_id")))
    grains = {"month": "month", "day": "day", "auto": auto_grain(hot, ["user_id"], "ts", target_rows=1000)}
    for label, g in grains.items():
        spark.sparkContext.setJobGroup(label, label)
        import quantlake.operators.panel as P
        orig = P.ordered_scan
        P.ordered_scan = lambda *a, **k: orig(*a, **{**k, "bucket": time_bucket(g)(F.col("ts"))})
        lagged(hot, ["user_id"], "ts", "value", tie_break=["event_id"]).write.format("noop").mode("overwrite").save()
        P.ordered_scan = orig
    spark.stop()
    stage_group, recs = {}, defaultdict(list)
    for path in sorted(p for p in glob.glob(os.path.join(logdir, "**", "*"), recursive=True) if os.path.isfile(p)):
        for line in open(path):
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                for s in e.get("Stage IDs", []):
                    stage_group[s] = (e.get("Properties") or {}).get("spark.jobGroup.id")
            elif e.get("Event") == "SparkListenerTaskEnd":
                r = ((e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                recs[(stage_group.get(e["Stage ID"]), e["Stage ID"])].append(r)
    print("| buckets | grain | busiest task's share of the window stage's rows |")
    print("| --- | --- | --- |")
    for label, g in grains.items():
        stages = [v for (grp, _), v in recs.items() if grp == label and sum(v) > 0]
        big = max(stages, key=sum)                    # the window stage reads the most shuffle records
        print(f"| {label} | {g} | {max(big) / sum(big):.1%} of {sum(big)} |")


if __name__ == "__main__":
    main()
