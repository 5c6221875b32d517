"""Calendar source: one row per day between two dates, inclusive (O-06)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.schemas import CALENDAR_END, CALENDAR_START


def date_spine(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """``explode(sequence(start, end, 1 day))``; 366 rows for the 2024 default."""
    return spark.range(1).select(
        F.explode(
            F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)), F.expr("INTERVAL 1 DAY"))
        ).alias("date_day")
    )


def date_spine_between(bounds: DataFrame, start_col: str = "start", end_col: str = "end") -> DataFrame:
    """Spine driven by data: ``bounds`` holds one row of DATE bounds (e.g. min/max pickup day)."""
    return bounds.select(
        F.explode(F.sequence(F.col(start_col), F.col(end_col), F.expr("INTERVAL 1 DAY"))).alias("date_day")
    )
