"""Load KPIs, counts and the three published reports (O-64, O-65, O-70..O-79).

Fact-to-dimension reports aggregate the fact by its foreign key *first*
(partial + final hash aggregate, output bounded by the number of distinct keys),
then join that small result to the dimension and roll up. The fact itself is
never joined row by row and no dimension needs to be broadcast, however large
either side grows. Inner-join semantics are kept: keys without a dimension row
drop out, duplicate dimension keys fan out exactly as a row-level join would.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.operators.cleanse import merge_one_row


def _avg(sum_col: str, n_col: str) -> Column:
    """AVG from partial sum and non-NULL count; NULL when nothing was counted."""
    return F.when(F.sum(n_col) > 0, F.sum(sum_col) / F.sum(n_col))


def _partials(value: str) -> list[Column]:
    return [F.sum(value).alias(f"__s_{value}"), F.count(value).alias(f"__n_{value}")]


def count_rows(df: DataFrame, name: str) -> DataFrame:
    """O-70: COUNT(*) as a one-row frame."""
    return df.agg(F.count(F.lit(1)).alias(name))


def kpi_load(trips: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """O-71 + load metrics: trips_loaded, zones_loaded, total_revenue, avg_distance, avg_duration.

    Sums are NULL on an empty input (plain SQL aggregate semantics). ``zones`` is
    None when the zone file was absent: zones_loaded is then 0.
    """
    k = trips.agg(
        F.count(F.lit(1)).alias("trips_loaded"),
        F.round(F.sum("total_amount"), 2).alias("total_revenue"),
        F.round(F.avg("trip_distance"), 2).alias("avg_distance"),
        F.round(F.avg("trip_duration_minutes"), 2).alias("avg_duration"),
    )
    if zones is None:
        z = k.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("zones_loaded"))
    else:
        z = count_rows(zones, "zones_loaded")
    return merge_one_row(k, z).select(
        "trips_loaded", "zones_loaded", "total_revenue", "avg_distance", "avg_duration"
    )


def report_borough_revenue(fct: DataFrame, dim_zones: DataFrame) -> DataFrame:
    """O-64 + O-74: trips, revenue and average tip % by pickup borough (inner join)."""
    per_zone = fct.groupBy("pickup_location_id").agg(
        F.count(F.lit(1)).alias("__trips"),
        *_partials("total_amount"),
        *_partials("tip_percentage"),
    )
    return borough_revenue(per_zone, dim_zones)


def borough_revenue(per_zone: DataFrame, dim_zones: DataFrame) -> DataFrame:
    """The borough report from trips, sums and counts per pickup zone."""
    z = dim_zones.select("location_id", "borough")
    joined = per_zone.join(z, per_zone["pickup_location_id"] == z["location_id"], "inner")
    return joined.groupBy("borough").agg(
        F.sum("__trips").alias("total_trips"),
        F.round(F.sum("__s_total_amount"), 2).alias("total_revenue_usd"),
        F.round(_avg("__s_tip_percentage", "__n_tip_percentage"), 2).alias("avg_tip_pct"),
    )


def report_top_boroughs(fct: DataFrame, dim_zones: DataFrame, k: int = 5) -> DataFrame:
    """O-78: top ``k`` boroughs by revenue (borough breaks ties). Plans as TakeOrderedAndProject."""
    return top_boroughs(report_borough_revenue(fct, dim_zones), k)


def top_boroughs(report: DataFrame, k: int = 5) -> DataFrame:
    return report.orderBy(F.col("total_revenue_usd").desc_nulls_last(), F.col("borough").asc_nulls_last()).limit(k)


def report_time_of_day(fct: DataFrame) -> DataFrame:
    """O-75 + O-79: demand by time-of-day segment, busiest first."""
    each = fct.groupBy("time_of_day_segment").agg(
        F.count(F.lit(1)).alias("trip_count"),
        F.round(F.avg("trip_distance_miles"), 2).alias("avg_distance_miles"),
        F.round(F.avg("fare_amount"), 2).alias("avg_fare_usd"),
    )
    return busiest_first(each)


def busiest_first(report: DataFrame) -> DataFrame:
    return report.orderBy(F.col("trip_count").desc(), F.col("time_of_day_segment").asc_nulls_last())


def report_weekend(fct: DataFrame, dim_date: DataFrame) -> DataFrame:
    """O-65 + O-76: weekday vs weekend via the date dimension (inner join drops days outside it)."""
    per_day = fct.groupBy("pickup_date").agg(
        F.count(F.lit(1)).alias("__trips"),
        *_partials("trip_distance_miles"),
        *_partials("total_amount"),
    )
    return weekend(per_day, dim_date)


def weekend(per_day: DataFrame, dim_date: DataFrame) -> DataFrame:
    """The weekend report from trips, sums and counts per pickup day."""
    d = dim_date.select("date_day", "is_weekend")
    joined = per_day.join(d, per_day["pickup_date"] == d["date_day"], "inner")
    return joined.groupBy("is_weekend").agg(
        F.sum("__trips").alias("trip_count"),
        F.round(_avg("__s_trip_distance_miles", "__n_trip_distance_miles"), 2).alias("avg_distance"),
        F.round(_avg("__s_total_amount", "__n_total_amount"), 2).alias("avg_total_fare"),
    )
