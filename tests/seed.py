"""Clean-layer trips and zones for model tests: plain rows, so goldens are worked out from them in Python."""

import datetime as dt

from fareline.schemas import TRIPS_CLEAN, ZONES_RAW

N_ZONES, N_TRIPS = 60, 120
BOROUGHS = ("North", "East", "South")


def zone_rows():
    return [(k, BOROUGHS[k * k % 3], f"Area {k:02d}", "Ring A" if k < 40 else "Ring B") for k in range(1, N_ZONES + 1)]


def trip_rows():
    """One dict per trip: a trip every 97 minutes from 2024-01-03 00:05 on."""
    out = []
    for i in range(N_TRIPS):
        start, minutes = dt.datetime(2024, 1, 3, 0, 5) + dt.timedelta(minutes=97 * i), 9 + i % 7
        miles, fare, tip = 0.75 + 0.25 * (i % 11), 8.25 + 0.5 * (i % 13), 0.5 * (i % 6)
        out.append(
            {
                "VendorID": 2 if i % 3 == 0 else 1,
                "tpep_pickup_datetime": start,
                "tpep_dropoff_datetime": start + dt.timedelta(minutes=minutes),
                "passenger_count": 1 + i * i % 5,
                "trip_distance": miles,
                "RatecodeID": 1 + i % 2,
                "store_and_fwd_flag": "Y" if i % 10 == 0 else "N",
                "PULocationID": 1 + 7 * i % N_ZONES,
                "DOLocationID": N_ZONES - 11 * i % N_ZONES,
                "payment_type": 1 + i % 4,
                "fare_amount": fare,
                "extra": 0.0,
                "mta_tax": 0.5,
                "tip_amount": tip,
                "tolls_amount": 0.0,
                "improvement_surcharge": 1.0,
                "total_amount": fare + tip + 1.5,
                "congestion_surcharge": 0.0,
                "Airport_fee": 0.0,
                "trip_duration_minutes": float(minutes),
                "avg_speed_mph": round(miles / minutes * 60, 2),
                "tip_percentage": round(tip / fare * 100, 2),
            }
        )
    return out


def seed_trips(spark):
    return spark.createDataFrame([tuple(r[f.name] for f in TRIPS_CLEAN.fields) for r in trip_rows()], TRIPS_CLEAN)


def seed_zones(spark):
    return spark.createDataFrame(zone_rows(), ZONES_RAW)
