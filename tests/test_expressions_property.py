"""Property test: label and measure expressions against plain-Python definitions."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fareline.functions import avg_speed_mph, duration_minutes, payment_method, time_of_day_segment, tip_percentage
from fareline.plans.month_job import round2
from fareline.schemas import PAYMENT_METHODS, SEGMENT_HOURS, TIME_OF_DAY_SEGMENTS

T0 = dt.datetime(2024, 1, 15, 0, 0, 0)


def py_segment(hour):
    for (lo, hi), label in zip(SEGMENT_HOURS, TIME_OF_DAY_SEGMENTS, strict=False):
        if hour is not None and lo <= hour <= hi:
            return label
    return TIME_OF_DAY_SEGMENTS[-1]


def py_payment(code):
    return PAYMENT_METHODS[code - 1] if code is not None and 1 <= code <= 6 else PAYMENT_METHODS[-1]


rows_st = st.lists(
    st.tuples(
        st.one_of(st.none(), st.integers(0, 23)),
        st.one_of(st.none(), st.integers(-2, 9)),
        st.integers(-3600, 50_000),
        st.one_of(st.none(), st.floats(0, 200, allow_nan=False).map(lambda x: round(x, 2))),
        st.one_of(st.none(), st.floats(0, 50, allow_nan=False).map(lambda x: round(x, 2))),
        st.floats(-5, 300, allow_nan=False).map(lambda x: round(x, 2)),
    ),
    min_size=1,
    max_size=40,
)


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows_st)
def test_expressions_match_python(spark, rows):
    data = [
        (None if h is None else T0 + dt.timedelta(hours=h, minutes=7), code, T0, T0 + dt.timedelta(seconds=sec), dist, tip, fare)
        for h, code, sec, dist, tip, fare in rows
    ]
    df = spark.createDataFrame(
        data, "ts timestamp_ntz, code int, p timestamp_ntz, d timestamp_ntz, dist double, tip double, fare double"
    ).select(
        time_of_day_segment("ts").alias("seg"),
        payment_method("code").alias("pay"),
        duration_minutes("p", "d").alias("dur"),
        "dist", "tip", "fare",
    ).select("*", avg_speed_mph("dist", "dur").alias("speed"), tip_percentage("tip", "fare").alias("tip_pct"))
    got = df.collect()
    for (h, code, sec, dist, tip, fare), r in zip(rows, got, strict=True):
        assert r["seg"] == py_segment(h)
        assert r["pay"] == py_payment(code)
        dur = round2(sec / 60.0)
        assert r["dur"] == dur
        if dist is None:
            assert r["speed"] is None or dur <= 0
        else:
            assert r["speed"] == (round2(dist / (dur / 60.0)) if dur > 0 else 0.0)
        if fare <= 0:
            assert r["tip_pct"] == 0.0
        else:
            assert r["tip_pct"] == (None if tip is None else round2(tip / fare * 100.0))
