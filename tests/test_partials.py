"""Partial aggregates merged over months equal the reports over the rows (O-71, O-74..O-79)."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from fareline.operators import models as M
from fareline.operators import partials as P
from fareline.operators import reports as R

DAY = dt.date(2024, 1, 1)
KIND = "pickup_location_id int, time_of_day_segment string, pickup_date date, total_amount double, tip_percentage double, trip_distance_miles double, fare_amount double, trip_duration_minutes double"


def fact(spark, n, seed):
    rng = random.Random(seed)
    some = lambda v: None if rng.random() < 0.1 else v
    rows = [
        (some(rng.randrange(6)), some(rng.choice("abc")), some(DAY + dt.timedelta(days=rng.randrange(400))), *(some(rng.randrange(1, 4000) / 4) for _ in range(5)))
        for _ in range(n)
    ]
    return spark.createDataFrame(rows, KIND)


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("sizes", [(0,), (1, 1), (700, 5, 300)])
def test_reports_over_merged_months(spark, sizes):
    months = [fact(spark, n, k) for k, n in enumerate(sizes)]
    whole, parts = months[0], P.trip_partials(months[0])
    for m in months[1:]:
        whole, parts = whole.unionAll(m), parts.unionAll(P.trip_partials(m))
    zones = spark.createDataFrame([(k, f"b{k % 3}", "z", "s") for k in range(5)] + [(2, "again", "z", "s")], "location_id int, borough string, zone_name string, service_zone string")
    dates = M.dim_date(spark)
    assert rows(P.report_borough_revenue(parts, zones)) == rows(R.report_borough_revenue(whole, zones))
    assert P.report_top_boroughs(parts, zones, 2).collect() == R.report_top_boroughs(whole, zones, 2).collect()
    assert P.report_time_of_day(parts).collect() == R.report_time_of_day(whole).collect()
    assert rows(P.report_weekend(parts, dates)) == rows(R.report_weekend(whole, dates))
    k = whole.agg(F.count("*"), F.round(F.sum("total_amount"), 2), F.round(F.avg("trip_distance_miles"), 2), F.round(F.avg("trip_duration_minutes"), 2)).first()
    assert tuple(P.report_kpis(parts).first()) == tuple(k)
    assert parts.count() <= sum(sizes)
