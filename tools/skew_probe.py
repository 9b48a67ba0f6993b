"""Skew probe: run skew-sensitive operators on a hot key and read the event log.

A key holding one third of ``lineitem`` is derived from the table
(``l_orderkey % 3 = 0``).  For each operator the probe reports the largest
shuffle read (records and bytes) of any single task, next to the hot
group's size: values well below the hot group mean no task received the
whole group.  Spark's native ``percentile`` is shown for reference: its
records are per-group value maps, so its bytes tell the story.  The event log goes to a fresh scratch folder (no UI, no server).

usage: python tools/skew_probe.py [sf_dir]
"""

from __future__ import annotations

import glob
import json
import os
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    scratch = tempfile.mkdtemp(prefix="skew-probe-")
    from pyspark.sql import SparkSession
    from pyspark.sql import functions as F
    spark = (SparkSession.builder.master("local[8]").appName("skew-probe")
             .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.shuffle.partitions", "16")
             .config("spark.sql.adaptive.coalescePartitions.enabled", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", scratch)
             .config("spark.eventLog.rolling.enabled", "false").config("spark.eventLog.compress", "false")
             .config("spark.checkpoint.dir", os.path.join(scratch, "ckpt"))
             .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    from ledgerlens.operators import aggregate as A
    from ledgerlens.operators import reshape as U
    from ledgerlens.operators import windows as W
    from ledgerlens.operators.ordering import group_quantiles

    li = spark.read.parquet(f"{sf}/lineitem.parquet")
    g = F.when(F.col("l_orderkey") % 3 == 0, F.lit("hot")).otherwise(
        F.concat(F.lit("k"), (F.col("l_orderkey") % 97).cast("string")))
    df = li.select(g.alias("g"), "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_returnflag")
    hot = df.where(F.col("g") == "hot").count()
    total = df.count()

    runs = {
        "group_quantiles": lambda: group_quantiles(df, ["g"], "l_extendedprice", {"median": 0.5, "p90": 0.9}),
        "group_quantiles, a third of the values equal": lambda: group_quantiles(
            df.withColumn("v", F.when(F.col("g") == "hot", 0.0).otherwise(F.col("l_extendedprice"))), [], "v", {"median": 0.5}),
        "dedupe_keep_first": lambda: U.dedupe_keep_first(df, ["g"], ["l_orderkey", "l_linenumber", "l_partkey"]),
        "mode_by": lambda: A.mode_by(df, "g", "l_returnflag"),
        "top_n_per_group": lambda: W.top_n_per_group(df, "g", "l_extendedprice", 10),
        "native_percentile (reference)": lambda: df.groupBy("g").agg(F.percentile("l_extendedprice", 0.5)),
    }
    results = {}
    for name, fn in runs.items():
        spark.sparkContext.setJobGroup(name, name)
        fn().write.format("noop").mode("overwrite").save()
    spark.stop()

    # job group -> max shuffle records read by one task
    logs = [p for p in glob.glob(os.path.join(scratch, "**", "*"), recursive=True)
            if os.path.isfile(p) and "ckpt" not in p]
    log = sorted(logs, key=os.path.getmtime)[-1]
    job_group, stage_group = {}, {}
    per_group: dict[str, int] = {}
    per_group_bytes: dict[str, int] = {}
    with open(log) as fh:
        for line in fh:
            ev = json.loads(line)
            kind = ev.get("Event")
            if kind == "SparkListenerJobStart":
                grp = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = grp
            elif kind == "SparkListenerTaskEnd":
                grp = stage_group.get(ev.get("Stage ID"))
                m = (ev.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}
                recs = m.get("Total Records Read", 0)
                nbytes = m.get("Remote Bytes Read", 0) + m.get("Local Bytes Read", 0)
                if grp:
                    per_group[grp] = max(per_group.get(grp, 0), recs)
                    per_group_bytes[grp] = max(per_group_bytes.get(grp, 0), nbytes)
    _ = job_group
    for name in runs:
        results[name] = {"max_records_per_task": per_group.get(name, 0),
                         "max_bytes_per_task": per_group_bytes.get(name, 0)}
    print(json.dumps({"rows": total, "hot_group_rows": hot, "shuffle_read": results}))


if __name__ == "__main__":
    main()
