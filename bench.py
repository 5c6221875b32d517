"""Benchmark; prints ONE JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Headline value (like the reference's published figures: build and test the
warehouse, then run the analytical reports over it):

* ``month_job``: the whole month job (cleanse, load, models, 40 data tests)
  writing its tables to a fresh folder under the session's checkpoint folder;
* ``mart_report_*``: the three headline reports over the marts it persisted, from the fact's partial
  aggregates (collected to the driver: at most five rows each).

``value`` = month_job + the three reports. Also reported, not in ``value``:
``query_*``, registered queries computed from the raw input tables end to end
(mapping, cleansing, both dedups, models), each run in full through the
``noop`` sink. Every timing is the median of several runs after one warm-up run:
``BENCH_HEADLINE_REPEAT`` (default 5) for the headline items, ``BENCH_REPEAT``
(default 3) for the others; ``best`` has the shortest of the same runs.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time
import uuid
from statistics import median

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = [
    "clean_trips",
    "fct_trips",
    "report_top5_boroughs",
    "report_time_of_day",
    "report_weekend",
    "kpi_load",
    "audit_metrics",
    "dq_summary",
]


def _sf(path: str):
    m = re.search(r"sf([0-9.]+)", path)
    return float(m.group(1)) if m else None


def main() -> None:
    from fareline.operators import partials as P
    from fareline.plans.catalog import QUERIES
    from fareline.plans.month_job import MonthJob, build_month
    from fareline.session import build_session, shared_dir
    from fareline.sources.testdata import raw_trips, raw_zones

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    headline_repeat = int(os.environ.get("BENCH_HEADLINE_REPEAT", "5"))
    spark = build_session(
        master=f"local[{cpus}]",
        shuffle_partitions=cpus,
        app="fareline-bench",
        extra={"spark.driver.memory": "8g"},
    )
    # month-job warehouses go under the session's shared checkpoint folder (a private one
    # only if none is configured); every database and table gets an explicit location there
    scratch = f"{shared_dir(spark)}/fareline-bench-{uuid.uuid4().hex[:12]}"

    def run(name: str) -> float:
        t = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    best = {}

    def took(name: str, seconds: list[float]) -> float:
        best[name] = round(min(seconds), 3)
        return round(median(seconds), 3)

    timings = {}
    for name in HEADLINE:
        run(name)  # warm-up
        timings[name] = took(f"query_{name}", [run(name) for _ in range(repeat)])

    def month_job(i: int) -> float:
        job = MonthJob(warehouse=f"{scratch}/wh{i}", year=2024, month=1, fail_on_test_error=False, prefix=f"b{i}_")
        t = time.perf_counter()
        build_month(spark, job, raw=raw_trips(spark, sf_dir), zones=raw_zones(spark, sf_dir))
        return time.perf_counter() - t

    month_job(0)
    pipe = took("month_job", [month_job(i) for i in range(1, headline_repeat + 1)])

    # Report latency over the persisted marts (what an analyst runs after the month job).
    partials = spark.table(f"b{headline_repeat}_marts.fct_trips_partials")
    dz, dd = (spark.table(f"b{headline_repeat}_marts.{t}") for t in ("dim_zones", "dim_date"))
    mart_reports = {
        "mart_report_top5_boroughs": lambda: P.report_top_boroughs(partials, dz, 5),
        "mart_report_time_of_day": lambda: P.report_time_of_day(partials),
        "mart_report_weekend": lambda: P.report_weekend(partials, dd),
    }
    mart = {}
    for name, q in mart_reports.items():
        q().collect()
        seconds = []
        for _ in range(headline_repeat):
            t = time.perf_counter()
            q().collect()
            seconds.append(time.perf_counter() - t)
        mart[name] = took(name, seconds)

    total = round(pipe + sum(mart.values()), 3)
    out = {
        "metric": "month_job_plus_headline_reports",
        "value": total,
        "unit": "sec",
        "queries": {"month_job": pipe, **mart, **{f"query_{k}": v for k, v in timings.items()}},
        "best": best,
        "sf": _sf(sf_dir),
        "cpus": cpus,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
