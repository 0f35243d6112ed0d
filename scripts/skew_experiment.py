"""Plain vs skew-safe plans on a skewed synthetic table (local timing).

Not part of the bench and not a registered query: a check of the skew
handling's cost and benefit.  One key holds a third of the rows, all tied on
one timestamp; the rest spread over a million keys.

    python scripts/skew_experiment.py [ROWS]
"""

from __future__ import annotations

import datetime as dt
import glob
import json
import os
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from submart.operators.joins import salted_left_join  # noqa: E402
from submart.session import RECOMMENDED_CONF, ensure_checkpoint_dir  # noqa: E402
from submart.sources import scd4_asof  # noqa: E402


RESULTS: dict[str, float] = {}


def timed(label, df):
    df.sparkSession.sparkContext.setJobGroup(label, label)
    t = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    RESULTS[label] = time.perf_counter() - t


def longest_tasks(events_dir: str) -> dict[str, float]:
    """Longest task (seconds) per job group, from the event log."""
    stage_group, out = {}, {}
    for path in glob.glob(os.path.join(events_dir, "**", "*"), recursive=True):
        if not os.path.isfile(path) or path.endswith(".crc") or "appstatus" in path:
            continue
        for line in open(path):
            ev = json.loads(line)
            if ev.get("Event") == "SparkListenerJobStart":
                group = (ev.get("Properties") or {}).get("spark.jobGroup.id")
                for sid in ev.get("Stage IDs", []):
                    stage_group[sid] = group
            elif ev.get("Event") == "SparkListenerTaskEnd":
                group = stage_group.get(ev.get("Stage ID"))
                info = ev.get("Task Info") or {}
                if group and info.get("Finish Time"):
                    secs = (info["Finish Time"] - info["Launch Time"]) / 1000
                    out[group] = max(out.get(group, 0.0), secs)
    return out


def main():
    n = int(sys.argv[1]) if len(sys.argv) > 1 else 24_000_000
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    b = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
         .config("spark.driver.memory", "12g").config("spark.sql.shuffle.partitions", "64")
         .config("spark.eventLog.enabled", "true").config("spark.eventLog.compress", "false")
         .config("spark.eventLog.dir", scratch + "/events"))
    os.makedirs(scratch + "/events", exist_ok=True)
    for k, v in RECOMMENDED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    spark.sparkContext.setLogLevel("ERROR")
    t0 = F.lit("2024-01-01 00:00:00").cast("timestamp")
    hot = F.col("id") % 3 == 0
    (spark.range(n, numPartitions=64).select(
        F.when(hot, F.lit(7)).otherwise(F.col("id") % 1_000_000 + 100).cast("int").alias("k"),
        F.when(hot, t0).otherwise(t0 - F.expr("make_interval(0, 0, 0, 0, 0, 0, id % 1000)"))
         .alias("ts"),
        F.col("id").alias("v"),
        F.sha2(F.col("id").cast("string"), 256).substr(1, 24).alias("pad"))
     .write.parquet(scratch + "/hist"))
    hist = spark.read.parquet(scratch + "/hist")
    run = dt.date(2024, 1, 2)
    print(f"rows {n:,}; key 7 holds {n // 3:,} rows, all tied")
    spark.sparkContext.setJobGroup("setup", "setup")
    timed("as-of, plain window", scd4_asof(hist, ["k"], "ts", run, skew_safe=False))
    timed("as-of, skew-safe", scd4_asof(hist, ["k"], "ts", run, skew_safe=True))
    lookup = spark.range(1_000_200).select(F.col("id").cast("int").alias("lk"),
                                           F.col("id").alias("lv"))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "false")
    timed("left join, plain shuffle (AQE skew off)",
          hist.join(lookup, F.col("k") == F.col("lk"), "left"))
    timed("left join, salted", salted_left_join(hist, lookup, "k", "lk"))
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    timed("left join, plain shuffle (AQE skew on)",
          hist.join(lookup, F.col("k") == F.col("lk"), "left"))
    # the profile's shape: the lookup is an as-of read (a window), so the
    # join's right side is not a bare shuffle and AQE cannot split the skew
    versions = spark.range(2_000_400).select((F.col("id") % 1_000_200).cast("int").alias("lk"),
                                             F.col("id").alias("lv"),
                                             (t0 - F.expr("make_interval(0,0,0,0,0,0,id)")).alias("lts"))
    asof_lookup = scd4_asof(versions, ["lk"], "lts", run, skew_safe=False).drop("rnk")
    timed("left join on as-of lookup, plain (AQE skew on)",
          hist.join(asof_lookup, F.col("k") == F.col("lk"), "left"))
    timed("left join on as-of lookup, salted",
          salted_left_join(hist, asof_lookup, "k", "lk"))
    spark.stop()
    longest = longest_tasks(scratch + "/events")
    print(f"{'case':48s} {'wall s':>7s} {'longest task s':>15s}")
    for label, secs in RESULTS.items():
        print(f"{label:48s} {secs:7.2f} {longest.get(label, 0):15.2f}")


if __name__ == "__main__":
    main()
