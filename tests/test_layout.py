"""File sizes and clustering of the stored fact (O-10, O-15)."""

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fareline.plans.month_job import MonthJob, build_month
from fareline.sinks import layout
from fareline.sinks.snapshots import Warehouse
from fareline.sources.testdata import raw_trips, raw_zones

SF001 = "/root/testdata/sf0.01"


def groups(folder):
    """(day min, day max, zone min, zone max, rows) of every row group."""
    out = []
    for f in sorted(folder.glob("*.parquet")):
        meta = pq.ParquetFile(f).metadata
        at = {meta.row_group(0).column(i).path_in_schema: i for i in range(meta.num_columns)} if meta.num_row_groups else {}
        for g in range(meta.num_row_groups):
            d, z = (meta.row_group(g).column(at[c]).statistics for c in ("pickup_date", "pickup_location_id"))
            out.append((d.min, d.max, z.min, z.max, meta.row_group(g).num_rows))
    return out


def touched(all_groups, day, zone):
    return sum(lo <= day <= hi and zl <= zone <= zh for lo, hi, zl, zh, _ in all_groups)


@pytest.mark.parametrize("hot", [False, True])
def test_a_day_and_zone_reads_few_row_groups(spark, tmp_path, hot):
    zone = F.when(F.col("id") % 3 == 0, 7).otherwise((F.col("id") * 7919) % 64) if hot else (F.col("id") * 7919) % 64
    rows = spark.range(60_000).select(
        (F.lit("2024-01-01").cast("date") + (F.col("id") % 30).cast("int")).alias("pickup_date"), zone.cast("int").alias("pickup_location_id"), F.col("id").alias("tie")
    )
    rows.repartition(24).write.parquet(str(tmp_path / "plain"))
    layout.clustered(rows, 24, "pickup_date", "pickup_location_id", "tie").write.parquet(str(tmp_path / "laid"))
    plain, laid = groups(tmp_path / "plain"), groups(tmp_path / "laid")
    day = plain[0][0]
    assert len(laid) == 24 and sum(g[4] for g in laid) == 60_000
    assert max(g[4] for g in laid) < 2 * 60_000 / 24  # sizes are even, also where a zone holds a third of the rows
    assert touched(plain, day, 33) == 24 and touched(laid, day, 33) <= 3
    back = spark.read.parquet(str(tmp_path / "laid"))
    assert back.exceptAll(rows).isEmpty() and back.count() == 60_000


def test_z_order_places(spark):
    df = spark.createDataFrame([("2000-01-01", 0), ("2000-01-01", 1), ("2000-01-02", 0), ("2000-01-04", 3), (None, None), ("1999-12-31", 2)], "d string, z int")
    got = [r[0] for r in df.select(layout.z_order("d", "z")).collect()]
    assert got[:5] == [0, 1, 2, 0b1111, 0] and got[5] == 0xAAAAAAAA + 4


def test_the_job_sizes_the_files_of_the_fact(spark, tmp_path):
    for db in ("raw", "staging", "intermediate", "marts"):
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    wh = Warehouse(spark, str(tmp_path / "wh"))
    sizes = {}
    for target in (128 << 20, 100_000):
        build_month(spark, MonthJob(warehouse=wh.root, fail_on_test_error=False, file_bytes=target), raw=raw_trips(spark, SF001), zones=raw_zones(spark, SF001))
        (folder,), _ = wh.folders("marts", "fct_trips")
        sizes[target] = [f.stat().st_size for f in __import__("pathlib").Path(folder).glob("*.parquet")]
    assert len(sizes[128 << 20]) == 1 and len(sizes[100_000]) > 3
    assert all(30_000 < s < 200_000 for s in sizes[100_000])


def test_a_small_table_is_written_by_all_cores():
    mb = 1 << 20
    assert [layout.files_for(n * mb, cores=12) for n in (0, 10, 16, 100, 200, 3000)] == [1, 1, 1, 6, 12, 24]
    assert layout.files_for(200 * mb) == 2 and layout.files_for(10 * mb, mb, 4) == 10


def test_the_job_writes_the_fact_with_all_cores(spark, tmp_path, monkeypatch):
    for db in ("raw", "staging", "intermediate", "marts"):
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    monkeypatch.setattr(layout, "ROW_GROUP_BYTES", 50_000)  # so that the test's month has some row groups
    wh = Warehouse(spark, str(tmp_path / "wh"))
    build_month(spark, MonthJob(warehouse=wh.root, fail_on_test_error=False), raw=raw_trips(spark, SF001), zones=raw_zones(spark, SF001))
    (folder,), _ = wh.folders("marts", "fct_trips")
    assert len(list(__import__("pathlib").Path(folder).glob("*.parquet"))) == spark.sparkContext.defaultParallelism
