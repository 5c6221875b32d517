"""Run the month job when a month file lands (Structured Streaming file trigger).

The reference is a monthly batch started by a scheduler. Here the schedule is
replaced by a file stream over the landing folder: each micro-batch carries one row per
file, its *path* alone (the ``binaryFile`` source with the content left unread). The
months in the batch are derived from the names of the folder's own entries
(``{type}_tripdata_{YYYY}-{MM}.parquet``, one file or a folder of part files; other names
are ignored), and for each month the ordinary batch job re-runs over that month's
files. Re-running a month is idempotent (month partition overwrite), so a month whose files arrive across several batches is
simply rebuilt, and the stream checkpoint guarantees each file is handled once.
With ``availableNow`` the stream drains the folder and stops, which is how a
scheduler would call it.
"""

from __future__ import annotations

import re
from collections import deque
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fareline.plans.month_job import MonthJob, build_month
from fareline.sources.files import read_trips

FILE_PATTERN = r"([a-z]+)_tripdata_(\d{4})-(\d{2})\.parquet(?:/[^/]+)?$"
FILE_ROWS = "path string, modificationTime timestamp, length bigint, content binary"
KEPT_RESULTS = 120  # months whose audit a running query remembers


def landed_months(files: DataFrame, folder: str | None = None, taxi_type: str = "yellow") -> DataFrame:
    """(taxi_type, year, month, path) of each landed month file of a taxi type, from its name.

    ``folder``: only entries of this folder itself count, not those of folders inside it.
    """
    p = F.col("path")
    inside = f"/{re.escape(folder.rstrip('/').rpartition('/')[2])}/" if folder else ""
    named = files.where(p.rlike(inside + FILE_PATTERN))
    return named.select(
        F.regexp_extract(p, FILE_PATTERN, 1).alias("taxi_type"),
        F.regexp_extract(p, FILE_PATTERN, 2).try_cast("int").alias("year"),
        F.regexp_extract(p, FILE_PATTERN, 3).try_cast("int").alias("month"),
        p,
    ).where((F.col("taxi_type") == taxi_type) & F.col("month").between(1, 12))


def start(
    spark: SparkSession,
    landing_dir: str,
    job: MonthJob,
    checkpoint: str,
    schema=None,
    zones: DataFrame | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Start the landing watch; returns the running query (``awaitTermination`` to drain)."""
    files = (
        spark.readStream.format("binaryFile")
        .schema(FILE_ROWS)
        .option("recursiveFileLookup", "true")  # a month may land as one file or a folder of parts
        .option("pathGlobFilter", "*.parquet")
        .load(landing_dir)
        .select("path")
    )
    results: deque[dict] = deque(maxlen=KEPT_RESULTS)

    def run_months(batch: DataFrame, epoch_id: int) -> None:
        months = landed_months(batch, landing_dir, job.taxi_type).select("year", "month").distinct()
        for row in months.orderBy("year", "month").collect():
            month_dir = f"{landing_dir.rstrip('/')}/{job.taxi_type}_tripdata_{row['year']:04d}-{row['month']:02d}.parquet"
            j = replace(job, year=row["year"], month=row["month"], raw_path=month_dir, from_layer="raw")
            out = build_month(spark, j, raw=read_trips(spark, month_dir, schema) if schema else None, zones=zones)
            results.append({"epoch": epoch_id, "year": row["year"], "month": row["month"], **(out["audit"] or {})})

    writer = files.writeStream.foreachBatch(run_months).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    q = writer.start()
    q.results = results  # per-month audit rows, for callers and tests
    return q
