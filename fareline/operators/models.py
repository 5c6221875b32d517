"""Star-schema models: staging, enrichment, fact and dimensions (O-50..O-63, O-37, O-60).

The model graph is plain function composition:

    raw trips -> stg_trips --+--> int_trips_enriched -> fct_trips
    raw zones -> stg_zones --+--> dim_zones
    (calendar) ------------------> dim_date
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline.functions.calendar import calendar_parts, is_weekend, pickup_date
from fareline.functions.labels import payment_method, time_of_day_segment
from fareline.functions.measures import trip_surrogate_key
from fareline.functions.sql import quote
from fareline.operators.dedup import keep_first
from fareline.operators.lookups import MAX_BROADCAST_ROWS, fits_broadcast
from fareline.operators.quality import unique_violations
from fareline.schemas import (
    CALENDAR_END,
    CALENDAR_START,
    FCT_TRIPS_COLUMNS,
    STAGING_DEDUP_KEYS,
    STG_TRIP_COLUMNS,
    TRIP_KEY_PARTS,
)
from fareline.sources.calendar import date_spine

def staging_dedup(clean: DataFrame) -> DataFrame:
    """O-60: one row per (vendor, pickup, PU, DO, total, passengers); dropoff is NOT in the key."""
    return keep_first(clean, STAGING_DEDUP_KEYS)


def stg_trips(clean: DataFrame) -> DataFrame:
    """O-50 + O-37 + O-60: dedup, surrogate key, rename and cast to 23 columns."""
    return staged(staging_dedup(clean))


def staged(clean: DataFrame) -> DataFrame:
    """The columns of stg_trips, without the dedup."""
    return clean.select(
        trip_surrogate_key(*TRIP_KEY_PARTS).alias("trip_id"),
        *[F.expr(f"CAST({quote(src)} AS {t}) AS {dst}") for src, t, dst in STG_TRIP_COLUMNS],
    )


def stg_zones(raw_zones: DataFrame) -> DataFrame:
    """O-51: location_id INT, borough, zone_name, service_zone."""
    return raw_zones.select(
        F.col("location_id").cast("int").alias("location_id"),
        F.col("borough").cast("string").alias("borough"),
        F.col("zone").cast("string").alias("zone_name"),
        F.col("service_zone").cast("string").alias("service_zone"),
    )


def _zone_role(zones: DataFrame, role: str) -> DataFrame:
    return zones.select(
        F.col("location_id").alias(f"__{role}_location_id"),
        F.col("borough").alias(f"{role}_borough"),
        F.col("zone_name").alias(f"{role}_zone"),
    )


def int_trips_enriched(stg: DataFrame, zones: DataFrame, max_broadcast_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """O-52, O-62, O-63: two LEFT lookups of the zone dimension (pickup and dropoff roles).

    Unresolved zones give NULL names and keep the trip. The zone frame is
    broadcast only after its size check; roles are aliased before joining.
    """
    small = fits_broadcast(zones, max_broadcast_rows)  # one size check serves both roles
    pu, do = _zone_role(zones, "pickup"), _zone_role(zones, "dropoff")
    if small:
        pu, do = F.broadcast(pu), F.broadcast(do)
    j = stg.join(pu, stg["pickup_location_id"] == pu["__pickup_location_id"], "left").join(
        do, stg["dropoff_location_id"] == do["__dropoff_location_id"], "left"
    )
    return j.select(
        "trip_id",
        "vendor_id",
        "pickup_location_id",
        "dropoff_location_id",
        "pickup_at",
        "dropoff_at",
        pickup_date("pickup_at").alias("pickup_date"),
        "pickup_borough",
        "pickup_zone",
        "dropoff_borough",
        "dropoff_zone",
        time_of_day_segment("pickup_at").alias("time_of_day_segment"),
        payment_method("payment_type_code").alias("payment_method"),
        is_weekend("pickup_at").alias("is_weekend"),
        "passenger_count",
        "trip_distance_miles",
        "trip_duration_minutes",
        "avg_speed_mph",
        "fare_amount",
        "tip_amount",
        "tip_percentage",
        "tolls_amount",
        "congestion_surcharge",
        "airport_fee",
        "total_amount",
    )


def trips_without_zones(stg: DataFrame) -> DataFrame:
    """stg_trips plus the derived columns of the later trip models, without the zone lookups.

    Every row-level rule and every report over the fact's own columns gives the same answer on it,
    because the LEFT lookups neither drop nor (with unique zone ids, which are tested) repeat rows.
    """
    return stg.select(
        "*",
        pickup_date("pickup_at").alias("pickup_date"),
        time_of_day_segment("pickup_at").alias("time_of_day_segment"),
        payment_method("payment_type_code").alias("payment_method"),
        is_weekend("pickup_at").alias("is_weekend"),
    )


def rule_frames(stg: DataFrame, zones: DataFrame) -> dict[str, DataFrame]:
    """Frames for the 40 rules when int_trips_enriched and fct_trips are not stored: one for all trip models,
    if the zone ids are unique (one small job); repeated ones fan the lookups out, so the models are built."""
    if not unique_violations(zones, "location_id").isEmpty():
        enriched = int_trips_enriched(stg, zones)
        return {"stg_trips": stg, "int_trips_enriched": enriched, "fct_trips": fct_trips(enriched), "stg_zones": zones, "dim_zones": dim_zones(zones)}
    trips = trips_without_zones(stg)
    return {"stg_trips": trips, "int_trips_enriched": trips, "fct_trips": trips, "stg_zones": zones, "dim_zones": zones}


def fct_trips(enriched: DataFrame) -> DataFrame:
    """O-53: the fact columns in mart order."""
    return enriched.selectExpr(*FCT_TRIPS_COLUMNS)


def dim_zones(zones: DataFrame) -> DataFrame:
    """O-54."""
    return zones.select("location_id", "borough", "zone_name", "service_zone")


def dim_date_from(days: DataFrame, column: str = "date_day") -> DataFrame:
    """O-55 over any frame of DATE values."""
    return days.select(*calendar_parts(column))


def dim_date(spark: SparkSession, start: str = CALENDAR_START, end: str = CALENDAR_END) -> DataFrame:
    """O-06 + O-55: calendar 2024-01-01..2024-12-31 by default (366 rows)."""
    return dim_date_from(date_spine(spark, start, end))


def star_schema(raw_clean: DataFrame, raw_zones_df: DataFrame, spark: SparkSession | None = None) -> dict[str, DataFrame]:
    """All models as lazy frames, keyed by model name."""
    stg = stg_trips(raw_clean)
    zones = stg_zones(raw_zones_df)
    enriched = int_trips_enriched(stg, zones)
    spark = spark or raw_clean.sparkSession
    return {
        "stg_trips": stg,
        "stg_zones": zones,
        "int_trips_enriched": enriched,
        "fct_trips": fct_trips(enriched),
        "dim_zones": dim_zones(zones),
        "dim_date": dim_date(spark),
    }
