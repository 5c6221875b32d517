"""File sizes and clustering of stored tables (O-10, O-15).

Without it a table gets one file per task, in whatever order the last shuffle left. ``clustered`` deals the
rows into a chosen number of files along a Z-order curve over a day and a zone: rows of near days and
near zones share files and row groups, so a filter on either, or both, skips most of them by their
minima and maxima.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TARGET_BYTES = 128 << 20
ROW_GROUP_BYTES = 16 << 20  # row groups are what a filter skips
_SPREAD = ((8, 0x00FF00FF), (4, 0x0F0F0F0F), (2, 0x33333333), (1, 0x55555555))


def _spread(x: Column) -> Column:
    """The 16 bits of a number with a zero bit between each two."""
    for shift, mask in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def z_order(day: str, zone: str) -> Column:
    """Place on the curve: bits of the day (since 2000, modulo 65,536) and the zone in turn; NULLs come first."""
    bits = F.lit(0xFFFF).cast("long")
    d = F.coalesce(F.datediff(F.col(day).cast("date"), F.lit("2000-01-01").cast("date")).cast("long").bitwiseAND(bits), F.lit(0).cast("long"))
    z = F.coalesce(F.col(zone).cast("long").bitwiseAND(bits), F.lit(0).cast("long"))
    return F.shiftleft(_spread(d), 1).bitwiseOR(_spread(z))


def files_for(n_bytes: int, target: int = TARGET_BYTES, cores: int = 1) -> int:
    """Files of about ``target`` bytes; more, so that every core writes one, while each has a row group's bytes."""
    return max(1, -(-n_bytes // target), min(cores, n_bytes // ROW_GROUP_BYTES))


def cores(spark: SparkSession) -> int:
    """Tasks that the session runs at once, as far as it tells."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # a Spark Connect session has no SparkContext
        return 1


def stored_bytes(spark: SparkSession, folder: str) -> int:
    """Size of a stored folder, from the file system's listing."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(path).getLength()


def clustered(df: DataFrame, files: int, day: str, zone: str, tie: str) -> DataFrame:
    """The rows in ``files`` ranges of the curve, sorted in each. ``tie`` orders the rows of one place, so a day
    and zone that hold much of the table are cut as well."""
    columns = df.columns
    placed = df.withColumn("__z", z_order(day, zone))
    return placed.repartitionByRange(files, "__z", tie).sortWithinPartitions("__z", tie).select(*columns)
