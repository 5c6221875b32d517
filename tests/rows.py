"""Hand-made raw trip rows for boundary tests."""

import datetime as dt

from fareline.schemas import RAW_TRIP_COLUMNS, TRIPS_RAW

BASE = dict(
    VendorID=1,
    tpep_pickup_datetime=dt.datetime(2024, 1, 15, 8, 0, 0),
    tpep_dropoff_datetime=dt.datetime(2024, 1, 15, 8, 20, 0),
    passenger_count=1.0,
    trip_distance=3.0,
    RatecodeID=1,
    store_and_fwd_flag="N",
    PULocationID=1,
    DOLocationID=2,
    payment_type=1,
    fare_amount=12.0,
    extra=1.0,
    mta_tax=0.5,
    tip_amount=2.0,
    tolls_amount=0.0,
    improvement_surcharge=1.0,
    total_amount=19.0,
    congestion_surcharge=2.5,
    Airport_fee=0.0,
)


def trip(**kw):
    d = dict(BASE)
    d.update(kw)
    return tuple(d[c] for c in RAW_TRIP_COLUMNS)


def frame(spark, rows, partitions=None):
    df = spark.createDataFrame(rows, TRIPS_RAW)
    return df.repartition(partitions) if partitions else df


def minutes_after(start, minutes):
    return start + dt.timedelta(seconds=round(minutes * 60))
