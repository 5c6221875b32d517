"""Skew probe: one dedup key holds a third of all rows. How much does the dedup shuffle ship?

    python tools/skew_probe.py /root/testdata/sf0.1 10 /tmp/scratch-dir

Rows are the mapped trips of the given events replicated N times (new ids);
every third event gets the same cleansing key (vendor, pickup, dropoff, PU, DO,
fare) while its other columns keep their own values, so the survivor choice
matters. The probe reports the records written by the dedup exchange (from the
Spark event log) and the reduce-stage task time spread, and checks the result.
"""

from __future__ import annotations

import glob
import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from fareline.operators import cleanse as C  # noqa: E402
from fareline.session import build_session  # noqa: E402
from fareline.sources.testdata import raw_trips_from_events  # noqa: E402


def main():
    sf_dir, n, scratch = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    logs = f"{scratch}/eventlog-{time.time_ns()}"
    os.makedirs(logs)
    spark = build_session(
        shuffle_partitions=32,
        extra={"spark.eventLog.enabled": "true", "spark.eventLog.dir": logs, "spark.eventLog.compress": "false",
               "spark.driver.memory": "16g"},
    )
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    stride = 1_000_003
    rep = ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("rep")).select(
        (F.col("event_id") + F.col("rep") * F.lit(stride)).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("rep"))).alias("ts"),
        "user_id", "event_type", "value", "props",
    ).repartition(16)
    raw = raw_trips_from_events(rep)
    hot = (F.hash("tpep_pickup_datetime", "trip_distance") % 3) == 0
    hot_pickup = F.lit("2024-01-15 12:00:00").cast("timestamp_ntz")
    skewed = raw.select(
        *[
            F.when(hot, v).otherwise(F.col(c)).alias(c)
            for c, v in [
                ("VendorID", F.lit(1)),
                ("tpep_pickup_datetime", hot_pickup),
                ("tpep_dropoff_datetime", hot_pickup + F.expr("INTERVAL 10 MINUTES")),
                ("PULocationID", F.lit(1)),
                ("DOLocationID", F.lit(2)),
                ("fare_amount", F.lit(10.0)),
            ]
        ],
        *[c for c in raw.columns if c not in C.CLEANSE_DEDUP_KEYS],
    ).select(*raw.columns)
    path = f"{scratch}/skewed-{time.time_ns()}"
    skewed.write.parquet(path)
    data = spark.read.parquet(path)
    total = data.count()
    hot_rows = data.where((F.col("tpep_pickup_datetime") == hot_pickup) & (F.col("fare_amount") == 10.0)).count()
    t = time.perf_counter()
    deduped = C.dedup_raw(data)
    n_out = deduped.count()
    elapsed = time.perf_counter() - t
    survivor = deduped.where(F.col("tpep_pickup_datetime") == hot_pickup).collect()
    spark.stop()
    files = [p for p in glob.glob(f"{logs}/**", recursive=True) if not os.path.isdir(p)]
    events = [json.loads(ln) for f in files for ln in open(f)]
    scopes = {}
    for e in events:
        if e["Event"] == "SparkListenerStageSubmitted":
            si = e["Stage Info"]
            scopes[si["Stage ID"]] = {json.loads(r["Scope"])["name"] for r in si["RDD Info"] if r.get("Scope")}
    map_stages = {s for s, names in scopes.items() if "WindowGroupLimit" in names and "Window" not in names}
    reduce_stages = {s for s, names in scopes.items() if "Window" in names}
    shuffle_written, reduce_tasks = 0, []
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics"):
            m = e["Task Metrics"]
            if e["Stage ID"] in map_stages:
                shuffle_written += m["Shuffle Write Metrics"]["Shuffle Records Written"]
            if e["Stage ID"] in reduce_stages:
                reduce_tasks.append(e["Task Info"]["Finish Time"] - e["Task Info"]["Launch Time"])
    reduce_tasks.sort()
    print(json.dumps({
        "rows": total,
        "hot_key_rows": hot_rows,
        "dedup_output_rows": n_out,
        "hot_key_survivors": len(survivor),
        "dedup_shuffle_records_written": shuffle_written,
        "dedup_sec": round(elapsed, 2),
        "reduce_task_ms_median": reduce_tasks[len(reduce_tasks) // 2] if reduce_tasks else None,
        "reduce_task_ms_max": reduce_tasks[-1] if reduce_tasks else None,
    }))


if __name__ == "__main__":
    main()
