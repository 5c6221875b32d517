"""Mergeable partial aggregates of the fact, kept per month at write and merged at read (O-71, O-74..O-79).

One row per pickup zone, time-of-day segment and pickup day holds the number of trips and, for each
measure, its sum and its number of values. Sums and counts add up, so months merge by one more
aggregation and averages come out at the end. A month has at most zones x segments x days rows,
whatever its trips are, so the reports of a backfilled fact read these small tables only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.operators import reports as R

GRAIN = ("pickup_location_id", "time_of_day_segment", "pickup_date")
MEASURES = ("total_amount", "tip_percentage", "trip_distance_miles", "fare_amount", "trip_duration_minutes")


def trip_partials(fct: DataFrame) -> DataFrame:
    """The partial aggregates of a fact frame (one hash aggregation, combined before its shuffle)."""
    sums = [c for m in MEASURES for c in (F.sum(m).alias(f"sum_{m}"), F.count(m).alias(f"n_{m}"))]
    return fct.groupBy(*GRAIN).agg(F.count(F.lit(1)).alias("trips"), *sums)


def merged(partials: DataFrame, by: str, *measures: str) -> DataFrame:
    """Partials of any months rolled up to one column, in the form that the reports join and finish."""
    sums = [c for m in measures for c in (F.sum(f"sum_{m}").alias(f"__s_{m}"), F.sum(f"n_{m}").alias(f"__n_{m}"))]
    return partials.groupBy(by).agg(F.sum("trips").alias("__trips"), *sums)


def _mean(measure: str, name: str) -> Column:
    n = F.sum(f"n_{measure}")
    return F.round(F.when(n > 0, F.sum(f"sum_{measure}") / n), 2).alias(name)


def report_borough_revenue(partials: DataFrame, dim_zones: DataFrame) -> DataFrame:
    return R.borough_revenue(merged(partials, "pickup_location_id", "total_amount", "tip_percentage"), dim_zones)


def report_top_boroughs(partials: DataFrame, dim_zones: DataFrame, k: int = 5) -> DataFrame:
    return R.top_boroughs(report_borough_revenue(partials, dim_zones), k)


def report_time_of_day(partials: DataFrame) -> DataFrame:
    each = partials.groupBy("time_of_day_segment").agg(
        F.sum("trips").alias("trip_count"), _mean("trip_distance_miles", "avg_distance_miles"), _mean("fare_amount", "avg_fare_usd")
    )
    return R.busiest_first(each)


def report_weekend(partials: DataFrame, dim_date: DataFrame) -> DataFrame:
    return R.weekend(merged(partials, "pickup_date", "trip_distance_miles", "total_amount"), dim_date)


def report_kpis(partials: DataFrame) -> DataFrame:
    """Trips, revenue, mean distance and duration of the fact's months; no trips give 0 and NULLs."""
    return partials.agg(
        F.coalesce(F.sum("trips"), F.lit(0)).alias("trips"),
        F.round(F.sum("sum_total_amount"), 2).alias("total_revenue"),
        _mean("trip_distance_miles", "avg_distance"),
        _mean("trip_duration_minutes", "avg_duration"),
    )
