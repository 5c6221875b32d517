"""Sinks: month-partitioned Parquet, catalogue tables and schemas (O-10..O-18).

Writes stay parallel (one file per task, never ``coalesce(1)``) and are
partitioned by the *run* month, taken from the job parameters rather than from
pickup times: a pickup on the first day of the next month belongs to both
month windows and lands in the partition of the run that read it.

Overwrite modes:

* ``month`` (default): only the run month's partition folder is replaced, also by a
  run of no rows, so months can be re-run and backfilled in any order.
* ``replace_all``: the reference's behaviour (replace the whole table), so
  a backfill loop keeps only the last month.

The folder decides what exists, not the session's catalogue. Plain month folders are swapped when
their write commits; tables that readers use meanwhile, and all layers of the month job, are
snapshots behind one log of commits (``snapshots``), so separate processes share a warehouse safely.
"""

from __future__ import annotations

from urllib.parse import urlparse

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from fareline.schemas import LAYERS
from fareline.sinks import snapshots

PARTITION_COLUMNS = ("year", "month")
MODES = ("month", "replace_all")


def with_run_month(df: DataFrame, year: int, month: int) -> DataFrame:
    return df.withColumn("year", F.lit(year).cast("int")).withColumn("month", F.lit(month).cast("int"))


def _writer(df: DataFrame, mode: str):
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    w = df.write.mode("overwrite").partitionBy(*PARTITION_COLUMNS)
    return w.option("partitionOverwriteMode", "dynamic" if mode == "month" else "static")


def write_month(df: DataFrame, path: str, year: int, month: int, mode: str = "month") -> None:
    """O-10/O-16: write one run month of a layer as Parquet under ``path/year=Y/month=M``.

    Dynamic overwrite swaps the month's folder when the write commits, but leaves it alone when
    there are no rows; an empty file then takes the old ones' place.
    """
    rows = Observation()
    framed = with_run_month(df, year, month).observe(rows, F.count(F.lit(1)).alias("n"))
    _writer(framed, mode).parquet(path)
    if rows.get["n"] == 0:
        df.limit(0).write.mode("overwrite").parquet(month_folder(path, year, month))


def month_folder(path: str, year: int, month: int) -> str:
    return f"{path.rstrip('/')}/year={int(year)}/month={int(month)}"


def create_layer_schemas(spark: SparkSession, layers=None, location: str | None = None, prefix: str = "") -> None:
    """O-12/O-13: ``CREATE DATABASE IF NOT EXISTS`` for each layer name, verbatim.

    ``location`` puts the database folders on shared storage (``{location}/{db}.db``)
    instead of the session's default warehouse folder.
    """
    for layer in layers or LAYERS:
        db = prefix + LAYERS[layer]
        where = f" LOCATION '{location.rstrip('/')}/{db}.db'" if location else ""
        spark.sql(f"CREATE DATABASE IF NOT EXISTS `{db}`{where}")


def _same_place(a: str, b: str) -> bool:
    x, y = urlparse(a), urlparse(b)
    return x.path.rstrip("/") == y.path.rstrip("/") and (x.scheme or "file", x.netloc) == (y.scheme or "file", y.netloc)


def check_location(spark: SparkSession, table: str, path: str) -> None:
    """A registered table must lie where the job writes: another warehouse in one catalogue is refused."""
    if not spark.catalog.tableExists(table):
        return
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").where("col_name = 'Location'").collect()
    if rows and not _same_place(rows[0]["data_type"], path):
        raise ValueError(f"{table} is registered at {rows[0]['data_type']}, not at {path}; use one warehouse per catalogue")


def replace_table(df: DataFrame, table: str, path: str) -> None:
    """O-11/O-15: replace a catalogue table from a frame; its snapshots lie below ``path``. Readers of the
    old rows finish, and a writer that dies leaves them (see ``snapshots``)."""
    snapshots.replace(df, path, table)


def register_table(spark: SparkSession, table: str, path: str) -> None:
    """Make the files at ``path`` readable as ``table``, with all partitions that lie there now."""
    check_location(spark, table, path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} USING parquet LOCATION '{path}'")
    if set(PARTITION_COLUMNS) <= set(spark.table(table).columns):
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def write_month_table(df: DataFrame, table: str, path: str, year: int, month: int, mode: str = "month") -> None:
    """Month-partitioned catalogue table; ``month`` mode swaps only this run's partition."""
    spark = df.sparkSession
    check_location(spark, table, path)
    write_month(df, path, year, month, mode)
    register_table(spark, table, path)


def create_view(df: DataFrame, name: str) -> None:
    """O-14: staging models are views (lazy; recomputed by each reader)."""
    df.createOrReplaceTempView(name)


def list_tables(spark: SparkSession, layer: str) -> list[str]:
    """O-17: table names of one layer database."""
    return sorted(t.name for t in spark.catalog.listTables(LAYERS[layer]))


def export_parquet(df: DataFrame, path: str) -> None:
    """O-18: export a query result as Parquet (parallel part files)."""
    df.write.mode("overwrite").parquet(path)
