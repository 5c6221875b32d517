"""Models, lookups and reports: seed goldens, invariants, schema contracts."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareline import schemas as S
from fareline.operators import models as M
from fareline.operators import reports as R
from tests.seed import BOROUGHS, N_TRIPS, N_ZONES, seed_trips, seed_zones, trip_rows, zone_rows


@pytest.fixture(scope="module")
def seed(spark):
    return M.star_schema(seed_trips(spark), seed_zones(spark), spark)


def test_seed_fact_goldens(spark, seed):
    fct, rows = seed["fct_trips"], trip_rows()
    assert fct.count() == N_TRIPS
    k = R.kpi_load(seed_trips(spark), seed_zones(spark)).first().asDict()
    assert k["trips_loaded"] == N_TRIPS and k["zones_loaded"] == N_ZONES
    assert k["total_revenue"] == pytest.approx(sum(r["total_amount"] for r in rows), abs=0.005)
    assert k["avg_distance"] == pytest.approx(sum(r["trip_distance"] for r in rows) / N_TRIPS, abs=0.006)
    assert k["avg_duration"] == pytest.approx(sum(r["trip_duration_minutes"] for r in rows) / N_TRIPS, abs=0.006)
    hours = [r["tpep_pickup_datetime"].hour for r in rows]
    names = {"Morning Rush": range(7, 10), "Midday": range(10, 16), "Evening Rush": range(16, 20), "Night": range(20, 24),
             "Late Night / Early Morning": range(7)}
    seg = {r["time_of_day_segment"]: r["trip_count"] for r in R.report_time_of_day(fct).collect()}
    assert seg == {n: sum(h in span for h in hours) for n, span in names.items()}
    pay = {r[0]: r[1] for r in fct.groupBy("payment_method").count().collect()}
    assert pay == dict.fromkeys(["Credit Card", "Cash", "No Charge", "Dispute"], N_TRIPS // 4)
    of = {z[0]: z[1] for z in zone_rows()}
    bor = {r["borough"]: r["total_trips"] for r in R.report_borough_revenue(fct, seed["dim_zones"]).collect()}
    want = {b: sum(of[r["PULocationID"]] == b for r in rows) for b in BOROUGHS}
    assert bor == {b: n for b, n in want.items() if n}
    wk = {r["is_weekend"]: r["trip_count"] for r in R.report_weekend(fct, seed["dim_date"]).collect()}
    weekend = sum(r["tpep_pickup_datetime"].weekday() >= 5 for r in rows)
    assert wk == {True: weekend, False: N_TRIPS - weekend}


def test_report_order_and_top_k(spark, seed):
    rows = R.report_time_of_day(seed["fct_trips"]).collect()
    counts = [r["trip_count"] for r in rows]
    assert counts == sorted(counts, reverse=True)
    top = R.report_top_boroughs(seed["fct_trips"], seed["dim_zones"], 2).collect()
    assert len(top) == 2
    from fareline.plans.explain import plan_text

    assert "TakeOrderedAndProject" in plan_text(R.report_top_boroughs(seed["fct_trips"], seed["dim_zones"], 5))


def test_schemas(seed):
    S.check_schema(seed["stg_trips"], S.STG_TRIPS, layer="stg_trips")
    S.check_schema(seed["stg_zones"], S.STG_ZONES, layer="stg_zones")
    S.check_schema(seed["int_trips_enriched"], S.INT_TRIPS_ENRICHED, layer="int")
    S.check_schema(seed["fct_trips"], S.FCT_TRIPS, layer="fct")
    S.check_schema(seed["dim_zones"], S.DIM_ZONES, layer="dim_zones")
    S.check_schema(seed["dim_date"], S.DIM_DATE, layer="dim_date")
    with pytest.raises(S.SchemaMismatch):
        S.check_schema(seed["fct_trips"].drop("trip_id"), S.FCT_TRIPS)


def test_dim_date(spark):
    d = M.dim_date(spark)
    assert d.count() == 366
    rows = {r["date_day"]: r for r in d.collect()}
    assert rows[dt.date(2024, 12, 30)]["iso_week"] == 1
    assert rows[dt.date(2024, 1, 1)]["day_of_week"] == "Monday"
    assert rows[dt.date(2024, 2, 29)]["quarter"] == 1
    assert sum(1 for r in rows.values() if r["is_weekend"]) == 104


def test_left_lookup_keeps_rows_and_unresolved_zone(spark):
    from fareline.operators.cleanse import cleanse
    from fareline.sources.testdata import raw_trips, raw_zones

    d = "/root/testdata/sf0.01"
    m = M.star_schema(cleanse(raw_trips(spark, d)), raw_zones(spark, d), spark)
    assert m["int_trips_enriched"].count() == m["stg_trips"].count() == 6137
    assert m["fct_trips"].where(F.col("pickup_borough").isNull()).count() == 418
    # report join is INNER: unresolved pickups vanish only there
    total = sum(r["total_trips"] for r in R.report_borough_revenue(m["fct_trips"], m["dim_zones"]).collect())
    assert total == 6137 - 418


def test_staging_dedup_ignores_dropoff(spark):
    from tests.rows import BASE, trip

    p = BASE["tpep_pickup_datetime"]
    rows = [trip(tpep_dropoff_datetime=p + dt.timedelta(minutes=20)), trip(tpep_dropoff_datetime=p + dt.timedelta(minutes=21), fare_amount=12.5)]
    from fareline.operators.cleanse import cleanse
    from tests.rows import frame

    clean = cleanse(frame(spark, rows))
    assert clean.count() == 2  # the cleansing key includes dropoff and fare
    stg = M.stg_trips(clean).collect()
    assert len(stg) == 1 and stg[0]["dropoff_at"] == p + dt.timedelta(minutes=20)  # earliest dropoff survives


def test_null_vendor_gives_null_trip_id(spark):
    from fareline.operators.cleanse import cleanse
    from tests.rows import frame, trip

    stg = M.stg_trips(cleanse(frame(spark, [trip(VendorID=None)]))).collect()
    assert len(stg) == 1 and stg[0]["trip_id"] is None


def test_zone_fan_out_is_visible(spark):
    zones = seed_zones(spark).unionByName(seed_zones(spark).where("location_id = 2"))
    m = M.star_schema(seed_trips(spark), zones, spark)
    assert m["int_trips_enriched"].count() > N_TRIPS  # left join fans out on duplicate zone ids
    from fareline.operators import quality as Q

    assert Q.unique_violations(m["dim_zones"], "location_id").count() == 1


def test_lookup_broadcast_is_size_checked(spark, seed):
    from fareline.operators.lookups import fits_broadcast
    from fareline.plans.explain import plan_text

    assert fits_broadcast(seed["stg_zones"], N_ZONES) and not fits_broadcast(seed["stg_zones"], N_ZONES - 1)
    assert not fits_broadcast(seed["stg_zones"], max_bytes=1_000)  # 60 rows x 4 columns exceed 1 kB
    small = M.int_trips_enriched(seed["stg_trips"], seed["stg_zones"])
    big = M.int_trips_enriched(seed["stg_trips"], seed["stg_zones"], max_broadcast_rows=10)
    hint = "strategy=broadcast"
    assert hint in plan_text(small, "extended")
    assert hint not in plan_text(big, "extended")  # over the bound: no hint, planner/AQE decide
    assert big.count() == small.count() == N_TRIPS


def test_load_golden(spark, tmp_path):
    """Load KPIs on one trip with DECIMAL measures and a one-line zone CSV."""
    from fareline import sinks
    from fareline.sources import read_trips, read_zones_csv

    p = str(tmp_path / "trips.parquet")
    spark.sql(
        "SELECT 1 AS VendorID, TIMESTAMP_NTZ '2024-01-01 10:00:00' AS tpep_pickup_datetime, "
        "TIMESTAMP_NTZ '2024-01-01 10:15:00' AS tpep_dropoff_datetime, 2.5 AS trip_distance, "
        "15.0 AS trip_duration_minutes, 20.0 AS fare_amount, 25.0 AS total_amount, "
        "100 AS PULocationID, 101 AS DOLocationID"
    ).write.parquet(p)
    csv = tmp_path / "zones.csv"
    csv.write_text("LocationID,Borough,Zone,service_zone\n100,Manhattan,Times Sq,Yellow Zone\n")
    trips, zones = read_trips(spark, p), read_zones_csv(spark, str(csv))
    k = R.kpi_load(trips, zones).first().asDict()
    assert k["trips_loaded"] == 1 and k["zones_loaded"] == 1
    assert float(k["total_revenue"]) == 25.0 and float(k["avg_distance"]) == 2.5 and float(k["avg_duration"]) == 15.0
    sinks.create_layer_schemas(spark, ["raw"])
    sinks.replace_table(trips, "raw.trips_load_test", str(tmp_path / "t"))
    sinks.replace_table(zones, "raw.zones_load_test", str(tmp_path / "z"))
    names = sinks.list_tables(spark, "raw")
    assert "trips_load_test" in names and "zones_load_test" in names
    assert zones.first().asDict() == {"location_id": 100, "borough": "Manhattan", "zone": "Times Sq", "service_zone": "Yellow Zone"}
    csv.write_text("service_zone,Zone,extra,LocationID,Borough\nYellow Zone,Times Sq,x,100,Manhattan\nA,B,x,oops,C\n")
    again = read_zones_csv(spark, str(csv))  # columns go by name
    assert again.first().asDict() == {"location_id": 100, "borough": "Manhattan", "zone": "Times Sq", "service_zone": "Yellow Zone"}
    from fareline.sources.files import bad_zone_ids

    assert bad_zone_ids(again) == 1
    csv.write_text("id,Borough,Zone,service_zone\n100,Manhattan,Times Sq,Yellow Zone\n")
    with pytest.raises(ValueError, match="no column LocationID"):
        read_zones_csv(spark, str(csv))


def test_optional_zone_file(spark, tmp_path):
    from fareline.sources import read_zones_optional

    assert read_zones_optional(spark, str(tmp_path / "missing.csv")) is None
    assert R.kpi_load(seed_trips(spark), None).first()["zones_loaded"] == 0


def test_kpi_on_empty_input_has_null_sums(spark):
    k = R.kpi_load(seed_trips(spark).where("false"), None).first().asDict()
    assert k["trips_loaded"] == 0 and k["total_revenue"] is None and k["avg_distance"] is None


def test_segments_partition_the_fact(spark):
    from fareline.operators.cleanse import cleanse
    from fareline.sources.testdata import raw_trips, raw_zones

    d = "/root/testdata/sf0.01"
    fct = M.star_schema(cleanse(raw_trips(spark, d)), raw_zones(spark, d), spark)["fct_trips"]
    seg = {r["time_of_day_segment"]: r["trip_count"] for r in R.report_time_of_day(fct).collect()}
    assert sum(seg.values()) == fct.count() == 6137
    assert seg == {"Morning Rush": 735, "Midday": 1505, "Evening Rush": 1075, "Night": 1082,
                   "Late Night / Early Morning": 1740}


def test_enrichment_same_rows_with_and_without_broadcast(spark):
    from fareline.operators.cleanse import cleanse
    from fareline.sources.testdata import raw_trips, raw_zones

    d = "/root/testdata/sf0.01"
    stg = M.stg_trips(cleanse(raw_trips(spark, d)))
    zones = M.stg_zones(raw_zones(spark, d))
    a = M.int_trips_enriched(stg, zones)
    b = M.int_trips_enriched(stg, zones, max_broadcast_rows=1)  # over the bound: planner decides
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0 and a.count() == 6137
