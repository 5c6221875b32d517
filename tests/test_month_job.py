"""The month job: end to end, resume, backfill modes, parameters (O-90..O-94, O-10..O-17)."""

import pytest
from pyspark.sql import functions as F

from fareline import sinks
from fareline.operators import quality as Q
from fareline.plans.month_job import MONTH_TABLES, MonthJob, backfill, build_month
from fareline.sinks.snapshots import Warehouse, key
from fareline.sources.files import table_name
from fareline.sources.testdata import raw_trips, raw_zones

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


def _drop_layers(spark):
    for db in ("raw", "staging", "intermediate", "marts"):
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")


def test_month_job_end_to_end(spark, tmp_path):
    _drop_layers(spark)
    job = MonthJob(warehouse=str(tmp_path / "wh"), count_duplicates=True)
    out = build_month(spark, job, raw=raw_trips(spark, SF0001), zones=raw_zones(spark, SF0001))
    assert out["audit"] == {
        "initial_rows": 1030, "clean_rows": 962, "dropped_rows": 68,
        "dropped_percentage": pytest.approx(68 / 1030 * 100), "duplicates_removed": 20,
    }
    assert out["load"]["trips_loaded"] == 962 and out["load"]["zones_loaded"] == 25
    # KPIs observed during the write equal a fresh aggregate over the loaded month
    from fareline.operators.reports import kpi_load

    month = spark.table(table_name("raw", "trips")).where("year = 2024 AND month = 1")
    kpis = kpi_load(month, spark.table(table_name("raw", "zones"))).first().asDict()
    assert {k: out["load"][k] for k in kpis} == kpis
    assert out["load"]["zones_without_id"] == 0 and out["load"]["trips_outside_calendar"] == 0
    assert len(out["tests"]) == 40 and all(t["failing_rows"] == 0 for t in out["tests"])
    assert spark.table(table_name("marts", "fct_trips")).count() == 953
    assert set(sinks.list_tables(spark, "marts")) >= {"fct_trips", "dim_zones", "dim_date"}
    assert spark.table(table_name("marts", "dim_date")).count() == 366

    # resume from the persisted clean layer: same models and tests, no cleansing
    again = build_month(spark, MonthJob(warehouse=str(tmp_path / "wh"), from_layer="clean"))
    assert again["audit"] is None and again["load"]["zones_loaded"] == 0
    assert all(t["failing_rows"] == 0 for t in again["tests"])
    assert spark.table(table_name("raw", "zones")).count() == 25  # old zones kept (no file given)


def test_failing_tests_stop_the_job(spark, tmp_path):
    _drop_layers(spark)
    job = MonthJob(warehouse=str(tmp_path / "wh"))
    with pytest.raises(Q.DataTestFailure, match="relationships_fct_trips_pickup_location_id.*=418"):
        build_month(spark, job, raw=raw_trips(spark, SF001), zones=raw_zones(spark, SF001))
    soft = MonthJob(warehouse=str(tmp_path / "wh2"), fail_on_test_error=False)
    _drop_layers(spark)
    out = build_month(spark, soft, raw=raw_trips(spark, SF001), zones=raw_zones(spark, SF001))
    assert out["audit"]["clean_rows"] == 6200 and out["load"]["trips_loaded"] == 6200


@pytest.mark.parametrize("mode,months", [("month", {(2023, 12), (2024, 1)}), ("replace_all", {(2024, 1)})])
def test_backfill_modes(spark, tmp_path, mode, months):
    _drop_layers(spark)
    job = MonthJob(warehouse=str(tmp_path / "wh"), mode=mode, fail_on_test_error=False)
    raw = raw_trips(spark, SF0001)
    backfill(spark, job, [(2023, 12), (2024, 1)], raw_for=lambda y, m: raw, zones=raw_zones(spark, SF0001))
    got = {(r["year"], r["month"]) for r in spark.table(table_name("raw", "trips")).select("year", "month").distinct().collect()}
    assert got == months
    fct_months = {(r[0], r[1]) for r in spark.table(table_name("marts", "fct_trips")).select("year", "month").distinct().collect()}
    assert fct_months == months


def test_rerun_month_is_idempotent(spark, tmp_path):
    path = str(tmp_path / "clean")
    raw = raw_trips(spark, SF0001)
    from fareline.operators.cleanse import cleanse

    for _ in range(2):
        sinks.write_month(cleanse(raw, 2024, 1), path, 2024, 1)
    sinks.write_month(cleanse(raw, 2023, 12), path, 2023, 12)
    df = spark.read.parquet(path)
    counts = {(r["year"], r["month"]): r["count"] for r in df.groupBy("year", "month").count().collect()}
    assert counts[(2024, 1)] == 962 and (2023, 12) in counts


def test_job_arguments():
    j = MonthJob.from_args(["--warehouse", "/w", "--year", "2023", "--month", "12", "--mode", "replace_all",
                            "--from-layer", "clean", "--no-fail-on-test-error"])
    assert (j.year, j.month, j.mode, j.from_layer, j.fail_on_test_error) == (2023, 12, "replace_all", "clean", False)
    assert j.path("marts", "fct_trips") == "/w/data/marts/fct_trips"


def test_month_source_naming():
    from fareline.sources import MonthSource

    s = MonthSource("/landing", 2024, 3, "green")
    assert s.path == "/landing/green_tripdata_2024-03.parquet"
    with pytest.raises(ValueError):
        MonthSource("/landing", 2024, 13)


def test_write_is_partitioned_not_single_file(spark, tmp_path):
    from fareline.operators.cleanse import cleanse
    from fareline.plans.explain import plan_text

    raw = raw_trips(spark, SF001)
    path = str(tmp_path / "clean")
    sinks.write_month(cleanse(raw).repartition(4), path, 2024, 1)
    files = list((tmp_path / "clean" / "year=2024" / "month=1").glob("*.parquet"))
    assert len(files) > 1
    pruned = spark.read.parquet(path).where((F.col("year") == 2024) & (F.col("month") == 1))
    assert "PartitionFilters: [isnotnull(year" in plan_text(pruned)
    from fareline.sources import read_partitioned_month

    month = read_partitioned_month(spark, path, 2024, 1)
    assert "PartitionFilters: [isnotnull(year" in plan_text(month) and month.count() == 6200
    assert read_partitioned_month(spark, path, 2024, 2).count() == 0


def test_rebuild_and_layer_reads(spark, tmp_path):
    """O-94 rebuild from the clean layer; O-08 layer reads; O-14 views exist."""
    from fareline.plans.month_job import rebuild_warehouse
    from fareline.sources import read_layer_table

    _drop_layers(spark)
    job = MonthJob(warehouse=str(tmp_path / "wh"))
    first = build_month(spark, job, raw=raw_trips(spark, SF0001), zones=raw_zones(spark, SF0001))
    assert spark.catalog.tableExists("stg_zones")
    assert read_layer_table(spark, "intermediate", "int_trips_enriched").count() == 953
    (again,) = rebuild_warehouse(spark, job)
    assert again["audit"] is None
    assert [t["failing_rows"] for t in again["tests"]] == [t["failing_rows"] for t in first["tests"]]
    fct = read_layer_table(spark, "marts", "fct_trips")
    assert fct.where("year = 2024 AND month = 1").count() == 953
    assert read_layer_table(spark, "raw", "trips").count() == 962


def test_duplicate_zone_ids_stop_before_the_fact(spark, tmp_path):
    _drop_layers(spark)
    zones = raw_zones(spark, SF0001)
    dup = zones.unionByName(zones.where("location_id = 3"))
    job = MonthJob(warehouse=str(tmp_path / "wh"))
    with pytest.raises(Q.DataTestFailure, match="unique_stg_zones_location_id=1"):
        build_month(spark, job, raw=raw_trips(spark, SF0001), zones=dup)
    assert not spark.catalog.tableExists(table_name("marts", "fct_trips"))


def test_round2_matches_spark_round(spark):
    from fareline.plans.month_job import round2

    values = [1.005, 2.675, 0.125, -0.125, 1234.5649999, 10.0, 0.0, 3.14159, 1e-7, 99.995]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.selectExpr("round(x, 2)").collect()]
    assert [round2(v) for v in values] == got
    assert round2(None) is None


def test_entry_point_reads_landed_files(spark, tmp_path):
    """O-93 + O-01 + O-03: the spark-submit entry over a landed month file and a zone CSV."""
    from fareline.plans.month_job import main

    _drop_layers(spark)
    landing = tmp_path / "landing"
    raw_trips(spark, SF0001).write.parquet(str(landing / "yellow_tripdata_2024-01.parquet"))
    zones = raw_zones(spark, SF0001).selectExpr(
        "location_id AS LocationID", "borough AS Borough", "zone AS Zone", "service_zone"
    )
    zones.write.option("header", True).csv(str(landing / "zones"))
    out = main([
        "--warehouse", str(tmp_path / "wh"),
        "--raw-path", str(landing / "yellow_tripdata_2024-01.parquet"),
        "--zone-csv", str(landing / "zones"),
        "--year", "2024", "--month", "1",
    ])
    assert out["audit"]["initial_rows"] == 1030 and out["audit"]["clean_rows"] == 962
    assert out["load"]["zones_loaded"] == 25
    assert all(t["failing_rows"] == 0 for t in out["tests"])


def test_default_month_job_pushes_rules_into_the_scan(spark, tmp_path):
    """Without the duplicate count, the key-only rules reach the Parquet scan of the landing."""
    from fareline.operators import cleanse as C
    from fareline.plans.explain import plan_text

    landing = str(tmp_path / "raw")
    raw_trips(spark, SF0001).write.parquet(landing)
    _drop_layers(spark)
    out = build_month(spark, MonthJob(warehouse=str(tmp_path / "wh"), raw_path=landing),
                      zones=raw_zones(spark, SF0001))
    assert out["audit"]["clean_rows"] == 962 and out["audit"]["duplicates_removed"] is None
    # the frame the job writes, built the same way: filters are pushed into the scan
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    frame = C.finish(C.rule_filter(C.with_measures(C.dedup_raw(spark.read.parquet(landing))), C.RULE_NAMES, 2024, 1))
    plan = plan_text(frame.observe(Observation("c"), F.count(F.lit(1))))
    assert "GreaterThanOrEqual(tpep_pickup_datetime" in plan


def test_rerun_with_no_clean_rows_empties_the_month(spark, tmp_path):
    _drop_layers(spark)
    job = MonthJob(warehouse=str(tmp_path / "wh"), fail_on_test_error=False)
    raw = raw_trips(spark, SF0001)
    build_month(spark, job, raw=raw, zones=raw_zones(spark, SF0001))
    assert spark.table(table_name("marts", "fct_trips")).where("year = 2024 AND month = 1").count() == 953
    out = build_month(spark, job, raw=raw.limit(0), zones=raw_zones(spark, SF0001))
    assert out["audit"]["clean_rows"] == 0
    for layer, name in [("raw", "trips"), ("staging", "stg_trips"), ("intermediate", "int_trips_enriched"), ("marts", "fct_trips")]:
        assert spark.table(table_name(layer, name)).where("year = 2024 AND month = 1").count() == 0, name


def test_a_boundary_trip_in_two_months_stops_the_job(spark, tmp_path):
    _drop_layers(spark)
    raw, zones = raw_trips(spark, SF0001), raw_zones(spark, SF0001)
    job = MonthJob(warehouse=str(tmp_path / "wh"), year=2023, month=12)
    first = build_month(spark, job, raw=raw, zones=zones)
    assert first["load"]["trips_outside_calendar"] > 0  # 2023 days are not in the 2024 calendar
    with pytest.raises(Q.DataTestFailure, match="unique_fct_trips_trip_id=22"):
        build_month(spark, MonthJob(warehouse=str(tmp_path / "wh")), raw=raw, zones=zones)


def test_a_failing_month_changes_no_layer(spark, tmp_path):
    """O-87/O-90: everything is tested before the commit that publishes it."""
    _drop_layers(spark)
    raw, zones = raw_trips(spark, SF0001), raw_zones(spark, SF0001)
    job = MonthJob(warehouse=str(tmp_path / "wh"))
    first = build_month(spark, job, raw=raw, zones=zones)
    stored = Warehouse(spark, job.warehouse)
    before, rows = stored.log(), {t: spark.table(table_name(*t)).count() for t in MONTH_TABLES[:4]}
    with pytest.raises(Q.DataTestFailure, match="unique_fct_trips_trip_id=22"):
        build_month(spark, MonthJob(warehouse=job.warehouse, year=2023, month=12), raw=raw, zones=zones.where("location_id <> 7"))
    worse = raw.withColumn("PULocationID", F.lit(999))
    with pytest.raises(Q.DataTestFailure, match="relationships"):  # a re-run of the published month itself
        build_month(spark, job, raw=worse, zones=zones)
    assert stored.log() == before and first["version"] == before["version"] == 1
    assert {t: spark.table(table_name(*t)).count() for t in MONTH_TABLES[:4]} == rows
    assert spark.table(table_name("raw", "zones")).count() == 25
    assert stored.vacuum(older_than_hours=0) > 0  # what the failed runs left
    assert {t: stored.read(*t).count() for t in MONTH_TABLES[:4]} == rows


def test_unchanged_months_are_skipped_and_stale_layers_refused(spark, tmp_path):
    """O-92/O-94: what a layer was made of is kept with it."""
    from fareline.plans.month_job import StaleLayer

    _drop_layers(spark)
    landing = str(tmp_path / "in")
    raw_trips(spark, SF0001).write.parquet(f"{landing}/yellow_tripdata_2024-01.parquet")
    raw_zones(spark, SF0001).selectExpr("location_id AS LocationID", "borough AS Borough", "zone AS Zone", "service_zone").write.option("header", True).csv(f"{landing}/zones")
    job = MonthJob(warehouse=str(tmp_path / "wh"), landing=landing, zone_csv=f"{landing}/zones", skip_unchanged=True)
    assert not build_month(spark, job)["skipped"]
    again = build_month(spark, job)
    assert again["skipped"] and again["version"] == 1
    raw_trips(spark, SF0001).limit(900).write.mode("overwrite").parquet(f"{landing}/yellow_tripdata_2024-01.parquet")
    newer = build_month(spark, job)
    assert not newer["skipped"] and newer["version"] == 2 and newer["audit"]["initial_rows"] == 900
    wh = Warehouse(spark, job.warehouse)
    k = key("raw", "trips", 2024, 1)
    wh.commit({k: {**wh.tables()[k], "contract": "of another day"}})
    with pytest.raises(StaleLayer, match="of another day"):
        build_month(spark, MonthJob(warehouse=job.warehouse, from_layer="clean"))
    assert not build_month(spark, job)["skipped"]  # a stale layer is made anew


def test_null_counts_come_from_footers(spark, tmp_path):
    from fareline.plans.explain import plan_text
    from fareline.sources.footers import footer_session, null_counts

    df = spark.range(1000).selectExpr("id", "CASE WHEN id % 7 = 0 THEN NULL ELSE cast(id AS string) END AS s", "timestamp_ntz'2024-01-01 00:00:00' AS t")
    df.repartition(3).write.parquet(str(tmp_path / "t"))
    session = footer_session(spark)
    got = null_counts(session, [str(tmp_path / "t")], df.schema, ["id", "s", "t", "s"])
    assert {r[0]: r[1] for r in got.collect()} == {"id": 0, "s": 143, "t": 0}
    assert "PushedAggregation: [COUNT(*), COUNT(id), COUNT(s), COUNT(t)]" in plan_text(got)
    assert [tuple(r) for r in null_counts(session, [str(tmp_path / "t")], df.schema, ["s"]).collect()] == [("s", 143)]
    assert spark.conf.get("spark.sql.sources.useV1SourceList") != ""
    df.limit(0).write.parquet(str(tmp_path / "none"))
    assert [r[1] for r in null_counts(session, [str(tmp_path / "none")], df.schema, ["id", "s"]).collect()] == [0, 0]


def test_rebuild_keeps_every_month(spark, tmp_path):
    from fareline.plans.month_job import rebuild_warehouse

    _drop_layers(spark)
    job = MonthJob(warehouse=str(tmp_path / "wh"), fail_on_test_error=False)
    raw = raw_trips(spark, SF0001)
    backfill(spark, job, [(2023, 12), (2024, 1)], raw_for=lambda y, m: raw, zones=raw_zones(spark, SF0001))
    before = spark.table(table_name("marts", "fct_trips")).count()
    _drop_layers(spark)  # as in a new process: the files stay, the catalogue knows nothing
    assert len(rebuild_warehouse(spark, job)) == 2
    assert spark.table(table_name("marts", "fct_trips")).count() == before == 982
    Warehouse(spark, job.warehouse).commit({key("raw", "trips", 2023, 12): None})
    rebuild_warehouse(spark, job)
    assert spark.table(table_name("marts", "fct_trips")).count() == 953


def test_another_warehouse_in_one_catalogue_is_refused(spark, tmp_path):
    _drop_layers(spark)
    raw, zones = raw_trips(spark, SF0001), raw_zones(spark, SF0001)
    build_month(spark, MonthJob(warehouse=str(tmp_path / "a")), raw=raw, zones=zones)
    with pytest.raises(ValueError, match="one warehouse per catalogue"):
        build_month(spark, MonthJob(warehouse=str(tmp_path / "b")), raw=raw, zones=zones)
    build_month(spark, MonthJob(warehouse=str(tmp_path / "b"), prefix="b_"), raw=raw, zones=zones)
    assert spark.table("b_marts.fct_trips").count() == 953


def test_month_write_of_no_rows_clears_the_folder(spark, tmp_path):
    from fareline.operators.cleanse import cleanse

    path, clean = str(tmp_path / "clean"), cleanse(raw_trips(spark, SF0001))
    sinks.write_month(clean, path, 2024, 1)
    sinks.write_month(cleanse(raw_trips(spark, SF0001), 2023, 12), path, 2023, 12)
    sinks.write_month(clean.limit(0), path, 2024, 1)
    assert [r["month"] for r in spark.read.parquet(path).select("month").distinct().collect()] == [12]


def test_landing_folder_and_calendar_arguments(spark, tmp_path):
    from fareline.plans.month_job import main

    _drop_layers(spark)
    raw_trips(spark, SF0001).write.parquet(str(tmp_path / "in" / "yellow_tripdata_2023-12.parquet"))
    raw_zones(spark, SF0001).selectExpr("service_zone", "zone AS Zone", "borough AS Borough", "location_id AS LocationID").write.option(
        "header", True
    ).csv(str(tmp_path / "zones"))
    out = main(["--warehouse", str(tmp_path / "wh"), "--landing", str(tmp_path / "in"), "--zone-csv", str(tmp_path / "zones"), "--year", "2023",
                "--month", "12", "--calendar-start", "2023-12-01", "--calendar-end", "2024-01-31"])
    assert out["load"]["trips_outside_calendar"] == 0 and out["load"]["trips_loaded"] > 0


def test_months_and_resume_in_separate_processes(tmp_path):
    """Three runs of the entry script on one warehouse: two months, then a resume of the first."""
    import os
    import subprocess
    import sys

    from pyspark.sql import SparkSession

    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    landing, wh = str(tmp_path / "in"), str(tmp_path / "wh")
    spark = SparkSession.active()
    for m in ("2024-01", "2023-12"):
        raw_trips(spark, SF0001).write.parquet(f"{landing}/yellow_tripdata_{m}.parquet")
    raw_zones(spark, SF0001).selectExpr("location_id AS LocationID", "borough AS Borough", "zone AS Zone", "service_zone").write.option(
        "header", True
    ).csv(f"{landing}/zones")
    months = lambda: {(r[0], r[1]): r[2] for r in Warehouse(spark, wh).read("marts", "fct_trips").groupBy("year", "month").count().collect()}

    def run(*extra):
        args = ["--warehouse", wh, "--no-fail-on-test-error", *extra]
        env = os.environ | {"PYTHONPATH": root, "PYSPARK_SUBMIT_ARGS": "--master local[2] --conf spark.ui.enabled=false pyspark-shell"}
        subprocess.run([sys.executable, f"{root}/run_month.py", *args], check=True, env=env, cwd=tmp_path, timeout=300, capture_output=True)

    run("--landing", landing, "--zone-csv", f"{landing}/zones", "--year", "2024", "--month", "1")
    run("--landing", landing, "--zone-csv", f"{landing}/zones", "--year", "2023", "--month", "12")
    both = months()
    assert both[2024, 1] == 953 and both[2023, 12] == 29
    Warehouse(spark, wh).commit({key("marts", "fct_trips", 2024, 1): None})
    run("--from-layer", "clean", "--year", "2024", "--month", "1")
    assert months() == both
