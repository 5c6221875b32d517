"""Cleansing rules, dedup survivor, rejects and audit (O-20..O-33, O-72, O-73)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareline.operators import cleanse as C
from tests.rows import BASE, frame, trip

P0 = BASE["tpep_pickup_datetime"]


def kept(spark, rows, year=2024, month=1):
    return C.cleanse(frame(spark, rows), year, month)


@pytest.mark.parametrize(
    "seconds,keep",
    [
        (59, False),  # 0.98 min
        (60, True),  # 1.0
        (43200, True),  # 720.0
        (43201, False),  # 720.0167 rounds to 720.02
        (43202, False),  # 720.03
    ],
)
def test_duration_range_on_rounded_minutes(spark, seconds, keep):
    row = trip(tpep_dropoff_datetime=P0 + dt.timedelta(seconds=seconds), trip_distance=0.5)
    rounded = round(seconds / 60.0, 2)
    assert kept(spark, [row]).count() == (1 if 1.0 <= rounded <= 720.0 else 0)


@pytest.mark.parametrize(
    "dist,keep",
    [(0.0, False), (0.01, True), (150.0, True), (150.01, False), (-1.0, False)],
)
def test_distance_bounds(spark, dist, keep):
    # two hours, so 150 miles is 75 mph and only the distance rule decides
    row = trip(trip_distance=dist, tpep_dropoff_datetime=P0 + dt.timedelta(hours=2))
    assert kept(spark, [row]).count() == (1 if keep else 0)


@pytest.mark.parametrize(
    "dist,keep",
    [
        (10.0, True),  # 100.0 mph
        (10.0004, True),  # 100.004 rounds to 100.0
        (10.0006, False),  # 100.006 rounds to 100.01
        (10.001, False),  # 100.01
    ],
)
def test_speed_cap_on_rounded_speed(spark, dist, keep):
    row = trip(trip_distance=dist, tpep_dropoff_datetime=P0 + dt.timedelta(minutes=6))
    assert kept(spark, [row]).count() == (1 if keep else 0)


def test_speed_100_004_passes(spark):
    # 10.0004 miles in 6 minutes is 100.004 mph: rounds to 100.0, kept, stored rounded
    row = trip(trip_distance=10.0004, tpep_dropoff_datetime=P0 + dt.timedelta(minutes=6))
    out = kept(spark, [row]).collect()
    assert len(out) == 1 and out[0]["avg_speed_mph"] == 100.0 and out[0]["trip_duration_minutes"] == 6.0


@pytest.mark.parametrize("fare,total,keep", [(0.0, 10.0, False), (10.0, 0.0, False), (0.01, 0.01, True), (None, 5.0, False)])
def test_fares(spark, fare, total, keep):
    assert kept(spark, [trip(fare_amount=fare, total_amount=total)]).count() == (1 if keep else 0)


def test_locations_not_null(spark):
    rows = [trip(PULocationID=None), trip(DOLocationID=None), trip(PULocationID=7)]
    assert kept(spark, rows).count() == 1


@pytest.mark.parametrize(
    "pickup,keep",
    [
        (dt.datetime(2024, 1, 1, 0, 0, 0), True),
        (dt.datetime(2023, 12, 31, 23, 59, 59), False),
        (dt.datetime(2024, 2, 1, 23, 59, 59), True),  # whole first day of next month is inside
        (dt.datetime(2024, 2, 2, 0, 0, 0), False),
    ],
)
def test_month_window_inclusive_next_first_day(spark, pickup, keep):
    row = trip(tpep_pickup_datetime=pickup, tpep_dropoff_datetime=pickup + dt.timedelta(minutes=20))
    assert kept(spark, [row]).count() == (1 if keep else 0)


def test_december_rolls_year(spark):
    rows = [
        trip(tpep_pickup_datetime=dt.datetime(2024, 1, 1, 23, 0), tpep_dropoff_datetime=dt.datetime(2024, 1, 1, 23, 20)),
        trip(tpep_pickup_datetime=dt.datetime(2024, 1, 2, 0, 0), tpep_dropoff_datetime=dt.datetime(2024, 1, 2, 0, 20)),
        trip(tpep_pickup_datetime=dt.datetime(2023, 12, 1, 0, 0), tpep_dropoff_datetime=dt.datetime(2023, 12, 1, 0, 20)),
    ]
    assert kept(spark, rows, 2023, 12).count() == 2
    assert C.month_window(2023, 12) == ("2023-12-01 00:00:00", "2024-01-01 23:59:59")


def test_dropoff_strictly_after_pickup(spark):
    assert kept(spark, [trip(tpep_dropoff_datetime=P0)]).count() == 0


def test_passengers_default_and_tip(spark):
    rows = [
        trip(passenger_count=None, total_amount=1.0, fare_amount=12.0),
        trip(passenger_count=0.0, total_amount=2.0, fare_amount=12.5),
        trip(passenger_count=3.0, total_amount=3.0, fare_amount=13.0, tip_amount=None),
    ]
    out = {r["total_amount"]: r for r in kept(spark, rows).collect()}
    assert out[1.0]["passenger_count"] == 1 and out[2.0]["passenger_count"] == 1
    assert out[3.0]["passenger_count"] == 3 and out[3.0]["tip_percentage"] is None
    assert out[1.0]["tip_percentage"] == round(2.0 / 12.0 * 100, 2)


def test_clean_schema(spark):
    from fareline.schemas import TRIPS_CLEAN, check_schema

    check_schema(kept(spark, [trip()]), TRIPS_CLEAN, layer="clean")


def test_dedup_survivor_is_first_by_other_columns(spark):
    # same cleansing key, different distance: the smaller distance survives, NULLs last
    rows = [trip(trip_distance=None), trip(trip_distance=5.0), trip(trip_distance=2.0), trip(trip_distance=9.0)]
    out = C.dedup_raw(frame(spark, rows)).collect()
    assert len(out) == 1 and out[0]["trip_distance"] == 2.0


def test_dedup_null_keys_group_together(spark):
    rows = [trip(VendorID=None), trip(VendorID=None), trip(VendorID=None, fare_amount=13.0)]
    assert C.dedup_raw(frame(spark, rows)).count() == 2


@pytest.mark.parametrize("parts", [1, 16])
def test_dedup_independent_of_partitioning(spark, parts):
    from fareline.sources.testdata import raw_trips

    raw = raw_trips(spark, "/root/testdata/sf0.001")
    base = sorted(map(tuple, C.cleanse(raw).collect()), key=str)
    other = sorted(map(tuple, C.cleanse(raw.repartition(parts)).collect()), key=str)
    assert base == other


def test_audit_invariants_sf001(spark):
    from fareline.sources.testdata import raw_trips

    raw = raw_trips(spark, "/root/testdata/sf0.01")
    a = C.audit_metrics(raw).first().asDict()
    assert a["initial_rows"] == 10292 and a["deduplicated_rows"] == 10098 and a["clean_rows"] == 6200
    assert a["clean_rows"] + a["dropped_rows"] == a["initial_rows"]
    assert a["dropped_percentage"] == pytest.approx(4092 / 10292 * 100)
    rej = {r["rule"]: r["rejected_rows"] for r in C.rejects_by_rule(raw).collect()}
    assert sum(rej.values()) == a["dropped_rows"]
    assert rej["duplicate"] == 194 and rej["duration_range"] == 2449 and rej["speed_cap"] == 332


def test_audit_on_empty_input(spark):
    a = C.audit_metrics(frame(spark, [])).first().asDict()
    assert a == {
        "initial_rows": 0, "deduplicated_rows": 0, "duplicates_removed": 0,
        "clean_rows": 0, "dropped_rows": 0, "dropped_percentage": 0.0,
    }


def test_filters_reach_scan_and_dedup_prefilters(spark, tmp_path):
    from fareline.sources.testdata import raw_trips

    path = str(tmp_path / "raw")
    raw_trips(spark, "/root/testdata/sf0.001").write.parquet(path)
    from fareline.plans.explain import plan_text

    df = C.cleanse(spark.read.parquet(path))
    plan = plan_text(df)
    pushed = [ln for ln in plan.splitlines() if ln.startswith("PushedFilters")][0]
    # key-column rules reach the scan; distance/total (non-key) must stay above the dedup
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in pushed and "GreaterThan(fare_amount" in pushed
    assert "trip_distance" not in pushed and "total_amount" not in pushed
    assert "row_number(), 1, Partial" in plan  # map-side limit before the exchange
    assert df.where(F.lit(True)).count() == 962
