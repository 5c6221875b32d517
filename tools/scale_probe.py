"""Scaling probe: replicate the driver's events N times (new ids), run the month job, time reports.

    python tools/scale_probe.py /root/testdata/sf0.1 30 /tmp/scratch-dir

The replica is derived from the given table with Spark (explode over a replica
number, ids shifted), written once, then used as the month's raw input.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from fareline.operators import reports as R  # noqa: E402
from fareline.plans.month_job import MonthJob, build_month  # noqa: E402
from fareline.session import build_session, shared_dir  # noqa: E402
from fareline.sources.testdata import raw_trips_from_events, raw_zones  # noqa: E402


def main():
    sf_dir, n, scratch = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session(
        master=f"local[{cpus}]", shuffle_partitions=cpus * 4, app="fareline-scale",
        extra={"spark.driver.memory": "16g", "spark.sql.warehouse.dir": f"{scratch}/warehouse"},
    )
    shared_dir(spark)
    ev = spark.read.parquet(f"{sf_dir}/events.parquet")
    stride = 1_000_003  # odd and coprime to the mapping's moduli: replicas get new keys
    rep_path = f"{scratch}/events_x{n}_32"
    if not os.path.exists(rep_path):
        ev.select("*", F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("rep")).select(
            (F.col("event_id") + F.col("rep") * F.lit(stride)).alias("event_id"),
            (F.col("ts") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.col("rep"))).alias("ts"), "user_id",
            "event_type", "value", "props",
        ).repartition(32).write.parquet(rep_path)  # 32 files: the scan splits into parallel tasks
    events = spark.read.parquet(rep_path)
    raw = raw_trips_from_events(events)
    out = {"replicas": n, "raw_rows": raw.count()}
    t = time.perf_counter()
    res = build_month(spark, MonthJob(warehouse=f"{scratch}/wh-{time.time_ns()}", fail_on_test_error=False),
                      raw=raw, zones=raw_zones(spark, sf_dir))
    out["month_job_sec"] = round(time.perf_counter() - t, 2)
    out["clean_rows"] = res["audit"]["clean_rows"]
    fct, dz, dd = (spark.table(f"marts.{t}") for t in ("fct_trips", "dim_zones", "dim_date"))
    for name, q in {
        "top5_boroughs": lambda: R.report_top_boroughs(fct, dz, 5),
        "time_of_day": lambda: R.report_time_of_day(fct),
        "weekend": lambda: R.report_weekend(fct, dd),
    }.items():
        q().collect()
        best = min((lambda s: (q().collect(), time.perf_counter() - s)[1])(time.perf_counter()) for _ in range(3))
        out[f"mart_{name}_sec"] = round(best, 3)
    print(json.dumps(out))


if __name__ == "__main__":
    main()
