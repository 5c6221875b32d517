"""Scalar expressions at their boundaries (O-30..O-40)."""

import datetime as dt

from pyspark.sql import functions as F

from fareline.functions import (
    avg_speed_mph,
    default_passengers,
    duration_minutes,
    is_weekend,
    iso_week,
    payment_method,
    pickup_date,
    time_of_day_segment,
    tip_percentage,
    trip_surrogate_key,
    weekday_name,
)


def one(spark, expr, schema, *rows):
    return [r[0] for r in spark.createDataFrame(list(rows), schema).select(expr).collect()]


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_duration_minutes(spark):
    got = one(
        spark,
        duration_minutes("p", "d"),
        "p timestamp_ntz, d timestamp_ntz",
        (ts("2024-01-01 12:00:00"), ts("2024-01-01 12:15:30")),
        (ts("2024-01-01 12:00:00.900"), ts("2024-01-01 12:01:00.100")),  # whole seconds: 60 s
        (ts("2024-03-10 01:30:00"), ts("2024-03-10 03:30:00")),  # no DST on NTZ
        (None, ts("2024-01-01 00:00:00")),
    )
    assert got == [15.5, 1.0, 120.0, None]


def test_speed(spark):
    got = one(
        spark,
        avg_speed_mph("dist", "dur"),
        "dist double, dur double",
        (5.0, 15.0),
        (3.0, 0.0),
        (3.0, -2.0),
        (None, 10.0),
    )
    assert got == [20.0, 0.0, 0.0, None]


def test_tip_percentage(spark):
    got = one(
        spark, tip_percentage("tip", "fare"), "tip double, fare double", (4.0, 20.0), (4.0, 0.0), (None, 20.0), (1.0, 3.0)
    )
    assert got == [20.0, 0.0, None, 33.33]


def test_default_passengers(spark):
    got = one(spark, default_passengers("p"), "p double", (None,), (0.0,), (-1.0,), (2.0,), (6.0,))
    assert got == [1, 1, 1, 2, 6]


def test_time_of_day_segment_hours(spark):
    hours = [0, 6, 7, 9, 10, 15, 16, 19, 20, 23]
    rows = [(ts(f"2024-01-15 {h:02d}:30:00"),) for h in hours] + [(None,)]
    got = one(spark, time_of_day_segment("t"), "t timestamp_ntz", *rows)
    late = "Late Night / Early Morning"
    assert got == [late, late, "Morning Rush", "Morning Rush", "Midday", "Midday", "Evening Rush",
                   "Evening Rush", "Night", "Night", late]


def test_payment_method_codes(spark):
    got = one(spark, payment_method("c"), "c int", (0,), (1,), (2,), (3,), (4,), (5,), (6,), (7,), (None,))
    assert got == ["Other", "Credit Card", "Cash", "No Charge", "Dispute", "Unknown", "Voided Trip", "Other", "Other"]


def test_weekend_and_names(spark):
    rows = [(ts("2024-01-06 10:00:00"),), (ts("2024-01-07 10:00:00"),), (ts("2024-01-08 10:00:00"),), (None,)]
    assert one(spark, is_weekend("t"), "t timestamp_ntz", *rows) == [True, True, False, None]
    assert one(spark, weekday_name("t"), "t timestamp_ntz", *rows) == ["Saturday", "Sunday", "Monday", None]
    assert one(spark, pickup_date("t"), "t timestamp_ntz", *rows)[0] == dt.date(2024, 1, 6)


def test_iso_week_year_end(spark):
    got = one(spark, iso_week("d"), "d date", (dt.date(2024, 12, 30),), (dt.date(2024, 1, 1),), (dt.date(2024, 12, 29),))
    assert got == [1, 1, 52]


def test_trip_key_is_null_propagating(spark):
    df = spark.createDataFrame(
        [(1, ts("2024-01-15 08:10:00"), 2, 3, 25.0, 1), (None, ts("2024-01-15 08:10:00"), 2, 3, 25.0, 1)],
        "v int, p timestamp_ntz, pu int, do int, tot double, pax int",
    )
    got = [r[0] for r in df.select(trip_surrogate_key("v", "p", "pu", "do", "tot", "pax")).collect()]
    import hashlib

    assert got[0] == hashlib.md5(b"1|2024-01-15 08:10:00|2|3|25.0|1").hexdigest()
    assert got[1] is None


def test_no_python_udfs_in_plans(spark):
    df = spark.createDataFrame([(ts("2024-01-15 08:10:00"), 1)], "t timestamp_ntz, c int").select(
        time_of_day_segment("t"), payment_method("c"), is_weekend("t"), F.lit(1)
    )
    from fareline.plans.explain import plan_text

    plan = plan_text(df, "extended")
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
