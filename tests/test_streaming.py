"""File-arrival trigger: each landed month file runs the month job once."""

from fareline.plans.month_job import MonthJob
from fareline.schemas import TRIPS_RAW
from fareline.sources.files import table_name
from fareline.sources.testdata import raw_trips, raw_zones
from fareline.streaming import start

SF = "/root/testdata/sf0.001"


def test_landing_stream_runs_each_month_once(spark, tmp_path):
    for db in ("raw", "staging", "intermediate", "marts"):
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    landing = tmp_path / "landing"
    raw = raw_trips(spark, SF)
    raw.write.parquet(str(landing / "yellow_tripdata_2024-01.parquet"))
    job = MonthJob(warehouse=str(tmp_path / "wh"), fail_on_test_error=False)
    ckpt = str(tmp_path / "ckpt")
    q = start(spark, str(landing), job, ckpt, TRIPS_RAW, zones=raw_zones(spark, SF))
    q.awaitTermination(300)
    assert [(r["year"], r["month"], r["clean_rows"]) for r in q.results] == [(2024, 1, 962)]

    # a second month lands; only it is processed on the next run
    raw.write.parquet(str(landing / "yellow_tripdata_2023-12.parquet"))
    q2 = start(spark, str(landing), job, ckpt, TRIPS_RAW, zones=raw_zones(spark, SF))
    q2.awaitTermination(300)
    assert [(r["year"], r["month"]) for r in q2.results] == [(2023, 12)]
    months = {(r[0], r[1]) for r in spark.table(table_name("marts", "fct_trips")).select("year", "month").distinct().collect()}
    assert months == {(2023, 12), (2024, 1)}


def test_two_months_in_one_batch(spark, tmp_path):
    for db in ("raw", "staging", "intermediate", "marts"):
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    landing = tmp_path / "landing"
    raw = raw_trips(spark, SF)
    raw.write.parquet(str(landing / "yellow_tripdata_2024-01.parquet"))
    raw.write.parquet(str(landing / "yellow_tripdata_2023-12.parquet"))
    job = MonthJob(warehouse=str(tmp_path / "wh"), fail_on_test_error=False)
    q = start(spark, str(landing), job, str(tmp_path / "ckpt"), TRIPS_RAW, zones=raw_zones(spark, SF))
    q.awaitTermination(300)
    assert sorted((r["year"], r["month"]) for r in q.results) == [(2023, 12), (2024, 1)]
    assert [r["clean_rows"] for r in sorted(q.results, key=lambda r: (r["year"], r["month"]))][1] == 962


def test_stray_and_nested_names_are_ignored(spark):
    from fareline.streaming.landing import landed_months

    names = ["/x/in/zones.parquet", "/x/in/yellow_tripdata_2024-01.parquet", "/x/in/old/yellow_tripdata_2024-02.parquet/p.parquet",
             "/x/in/yellow_tripdata_2024-03.parquet/part-0.parquet", "/x/in/green_tripdata_2024-01.parquet", "/x/in/yellow_tripdata_2024-13.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "path string")
    assert sorted((r["year"], r["month"]) for r in landed_months(df, "/x/in/").collect()) == [(2024, 1), (2024, 3)]
