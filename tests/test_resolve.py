"""Landed files whose columns drift, brought to one layout (O-01, O-02, O-05)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareline.plans.explain import plan_text
from fareline.schemas import RAW_TRIP_COLUMNS, TRIPS_RAW, SchemaMismatch
from fareline.sources import read_landed, resolve_trips
from tests.rows import frame, trip

UTC_PICKUP = dt.datetime(2024, 3, 10, 2, 30)  # an hour that New York's clocks skip


def same(a, b):
    return sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def test_the_layout_itself_is_left_alone(spark, tmp_path):
    path = str(tmp_path / "yellow_tripdata_2024-01.parquet")
    frame(spark, [trip(), trip(VendorID=2)], 1).write.parquet(path)
    out = read_landed(spark, path)
    assert [(f.name, f.dataType) for f in out.schema] == [(f.name, f.dataType) for f in TRIPS_RAW]
    assert "PushedFilters: [IsNotNull(fare_amount), GreaterThan(fare_amount,1.0)]" in plan_text(out.where("fare_amount > 1"))


def test_green_names_and_pushdown(spark, tmp_path):
    path = str(tmp_path / "green_tripdata_2024-01.parquet")
    rows = frame(spark, [trip(), trip(fare_amount=0.5)], 1)
    renamed = rows.withColumnsRenamed({"tpep_pickup_datetime": "lpep_pickup_datetime", "tpep_dropoff_datetime": "lpep_dropoff_datetime"})
    renamed.drop("Airport_fee").withColumn("trip_type", F.lit(2)).write.parquet(path)
    out = read_landed(spark, path)
    assert out.columns == RAW_TRIP_COLUMNS and same(out, rows.withColumn("Airport_fee", F.lit(None).cast("double")).select(*RAW_TRIP_COLUMNS))
    plan = plan_text(out.where("tpep_pickup_datetime >= TIMESTAMP_NTZ'2024-01-01 00:00:00'"))
    assert "GreaterThanOrEqual(lpep_pickup_datetime" in plan


def test_parts_of_different_months_are_read_together(spark, tmp_path):
    base = frame(spark, [trip(tpep_pickup_datetime=UTC_PICKUP, VendorID=k, passenger_count=float(k)) for k in range(6)], 1)
    a = base.where("VendorID < 2").withColumns({"PULocationID": F.col("PULocationID").cast("bigint"), "passenger_count": F.col("passenger_count").cast("bigint")})
    a.withColumnRenamed("Airport_fee", "airport_fee").write.parquet(str(tmp_path / "in" / "x"))
    b = base.where("VendorID IN (2, 3)").withColumns({"RatecodeID": F.col("RatecodeID").cast("double"), "fare_amount": F.col("fare_amount").cast("decimal(8,2)")})
    b.write.parquet(str(tmp_path / "in" / "y"))
    zone = spark.conf.get("spark.sql.session.timeZone")
    instants = base.where("VendorID > 3").withColumns({c: F.col(c).cast("timestamp") for c in ("tpep_pickup_datetime", "tpep_dropoff_datetime")})
    instants.write.parquet(str(tmp_path / "in" / "z"))
    try:
        for tz in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", tz)
            assert same(read_landed(spark, str(tmp_path / "in")), base), tz
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_what_cannot_be_read_fails_by_name(spark):
    rows = frame(spark, [trip()])
    with pytest.raises(SchemaMismatch, match="no column for fare_amount"):
        resolve_trips(rows.drop("fare_amount"))
    with pytest.raises(SchemaMismatch, match="column trip_distance: string"):
        resolve_trips(rows.withColumn("trip_distance", F.lit("3 miles")))
    with pytest.raises(SchemaMismatch, match="both stand for tpep_pickup_datetime"):
        resolve_trips(rows.withColumnsRenamed({"tpep_pickup_datetime": "lpep_pickup_datetime", "extra": "LPEP_pickup_datetime"}).withColumn("extra", F.lit(1.0)))
    odd = rows.withColumns({"VendorID": F.lit(2**40), "payment_type": F.lit(1.5), "RatecodeID": F.lit(None)})
    got = resolve_trips(odd).first()
    assert got["VendorID"] is None and got["payment_type"] is None and got["RatecodeID"] is None  # no such codes
    both = rows.withColumn("lpep_pickup_datetime", F.lit("no time"))
    assert same(resolve_trips(both), rows)  # the exact name wins


def test_green_month_through_the_job_and_the_landing(spark, tmp_path):
    from fareline.plans.catalog import _as_green
    from fareline.plans.month_job import MonthJob
    from fareline.sinks.snapshots import Warehouse
    from fareline.sources.testdata import raw_trips, raw_zones
    from fareline.streaming import start

    sf = "/root/testdata/sf0.001"
    landing = str(tmp_path / "in")
    _as_green(raw_trips(spark, sf)).write.parquet(f"{landing}/green_tripdata_2024-01.parquet")
    raw_trips(spark, sf).write.parquet(f"{landing}/yellow_tripdata_2024-01.parquet")
    job = MonthJob(warehouse=str(tmp_path / "green"), taxi_type="green", prefix="green_")
    q = start(spark, landing, job, str(tmp_path / "ckpt"), zones=raw_zones(spark, sf))
    q.awaitTermination(300)
    assert [(r["year"], r["month"], r["clean_rows"]) for r in q.results] == [(2024, 1, 962)]
    fct = Warehouse(spark, job.warehouse).read("marts", "fct_trips")
    assert fct.count() == 953 and fct.where("airport_fee IS NOT NULL").count() == 0
