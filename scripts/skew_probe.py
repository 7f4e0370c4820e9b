"""Skew evidence: the largest task when one key holds ~40% of the rows, for a
running sum (plain per-key window vs chunked prefix scan) and for a +-2 h
interval join (plain key join vs time-bucketed join; broadcast and AQE skew
join are switched off to show the plans' own distribution).

The hot key is derived from the given events (every 'view' and 'click' row
gets id 'HOT').  Each variant runs in its own Spark application with the
event log written to a fresh scratch folder; the log's task-end records give
the records each task read from the shuffle.  Prints one JSON line.

    python scripts/skew_probe.py [sf_dir]

The chunked scan runs at the shipped settings; the number of its chunks is
printed with the result.
"""

from __future__ import annotations

import glob
import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)


def run_variant(variant: str, sf_dir: str) -> dict:
    log_dir = tempfile.mkdtemp(prefix="run-skew-")
    code = f"""
import sys
sys.path.insert(0, {ROOT!r})
from pyspark.sql import Window, functions as F
from streamops.session import get_session
from streamops.sources.tables import sensor
from streamops.operators.rolling import rolling_sum
spark = get_session("local[8]", shuffle_partitions=8, extra={{
    "spark.eventLog.enabled": "true", "spark.eventLog.dir": {log_dir!r}, "spark.eventLog.compress": "false",
    "spark.sql.adaptive.coalescePartitions.enabled": "false"}})
s = sensor(spark, {sf_dir!r}).withColumn(
    "id", F.when(F.col("event_type").isin("view", "click"), F.lit("HOT")).otherwise(F.col("id")))
from streamops.operators.joins import interval_join, interval_join_bucketed
spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
if {variant!r} == "plain_window":
    w = Window.partitionBy("id").orderBy("arrival").rowsBetween(Window.unboundedPreceding, 0)
    out = s.select("arrival", "id", F.sum("vc").over(w).alias("vc"))
elif {variant!r} == "chunked_scan":
    out = rolling_sum(s)
else:
    l, r = s.where("event_type IN ('click', 'signup')"), s.where("event_type IN ('view', 'purchase')")
    f = interval_join if {variant!r} == "interval_plain" else interval_join_bucketed
    out = f(l, r, -2 * 3600 * 1000, 2 * 3600 * 1000)
out.write.format("noop").mode("overwrite").save()
spark.stop()
"""
    subprocess.run([sys.executable, "-c", code], check=True, capture_output=True, timeout=900)
    best, total = 0, 0
    for f in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(f) or os.path.basename(f).startswith("appstatus"):
            continue
        for line in open(f):
            ev = json.loads(line)
            if ev.get("Event") != "SparkListenerTaskEnd":
                continue
            m = ev.get("Task Metrics") or {}
            r = (m.get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
            best = max(best, r)
            total += r
    return {"max_task_shuffle_records": best, "total_shuffle_records": total}


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    res = {v: run_variant(v, sf_dir)
           for v in ("plain_window", "chunked_scan", "interval_plain", "interval_bucketed")}
    from streamops.plans.scan import density_chunk
    from streamops.session import get_session
    from streamops.sources.tables import sensor
    spark = get_session("local[2]", shuffle_partitions=2)
    s = sensor(spark, sf_dir)
    chunks = s.select(density_chunk(s, "arrival").alias("c")).distinct().count()
    spark.stop()
    print(json.dumps({"sf_dir": sf_dir, "chunks": chunks, **res}))


if __name__ == "__main__":
    main()
