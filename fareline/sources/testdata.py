"""Map the driver's test tables onto raw trips and raw zones (FIXTURES.md section 6).

``events`` carries real clock times inside January 2024, so each event becomes a trip.
A few events are emitted more than once (copy number ``k``) to exercise both dedups:

* k = 1: exact duplicate                     (event_id % 101 = 0)
* k = 2: dropoff 60 s later                  (event_id % 103 = 0) -> only the staging dedup
* k = 3: distance + 200                      (event_id % 107 = 0) -> survivor choice matters

The copies come from one scan through ``explode`` of a filtered array of copy
numbers (a narrow Generate), not a union of four scans.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- Fixed values of the fixture mapping -----------------------------------
# Copy number -> event_id modulus that selects the extra copy.
COPY_MODULI = {1: 101, 2: 103, 3: 107}
PICKUP_SHIFT_MOD = 97  # pickup moved 40 days back (outside the month)
PICKUP_SHIFT_DAYS = 40
NULL_PASSENGERS_MOD = 11
NULL_PICKUP_ZONE_MOD = 53
NULL_TIP_MOD = 13
STORE_FWD_MOD = 29
TOLLS_MOD = 19
TOLLS_VALUE = 6.94
AIRPORT_FEE_MOD = 23
AIRPORT_FEE_VALUE = 1.75
# ---------------------------------------------------------------------------


def raw_trips_from_events(events: DataFrame) -> DataFrame:
    """Raw yellow-trip records (19 columns, file order) derived from ``events``.

    Written as one projection of SQL expressions (one JVM call per column).
    """
    copies = ", ".join(f"CASE WHEN event_id % {m} = 0 THEN {k} END" for k, m in sorted(COPY_MODULI.items()))
    ev = events.selectExpr(
        "event_id AS i", "ts", "user_id", "value",
        f"explode(filter(array(0, {copies}), x -> x IS NOT NULL)) AS k",
    ).selectExpr(
        "*",
        f"""CASE WHEN i % {PICKUP_SHIFT_MOD} = 0
                 THEN CAST(date_trunc('second', ts) AS TIMESTAMP_NTZ) - INTERVAL {PICKUP_SHIFT_DAYS} DAYS
                 ELSE CAST(date_trunc('second', ts) AS TIMESTAMP_NTZ) END AS pickup""",
        "CAST(i % 17 AS DOUBLE) / 4.0D AS quarter_of_17",
    )
    return ev.selectExpr(
        "CAST(1 + i % 2 AS INT) AS VendorID",
        "pickup AS tpep_pickup_datetime",
        "pickup + make_dt_interval(0, 0, 0, CAST((i * 37) % 60000 - 300 + CASE WHEN k = 2 THEN 60 ELSE 0 END AS INT))"
        " AS tpep_dropoff_datetime",
        f"CASE WHEN i % {NULL_PASSENGERS_MOD} = 0 THEN CAST(NULL AS DOUBLE) ELSE CAST(i % 6 AS DOUBLE) END"
        " AS passenger_count",
        "CAST((i * 13) % 16000 AS DOUBLE) / 100.0D + CASE WHEN k = 3 THEN 200.0D ELSE 0.0D END AS trip_distance",
        "CAST(1 + i % 6 AS INT) AS RatecodeID",
        f"CASE WHEN i % {STORE_FWD_MOD} = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag",
        f"CASE WHEN i % {NULL_PICKUP_ZONE_MOD} = 0 THEN CAST(NULL AS INT) ELSE CAST(user_id % 27 AS INT) END"
        " AS PULocationID",
        "CAST((user_id * 7 + i) % 25 AS INT) AS DOLocationID",
        "CAST(i % 8 AS INT) AS payment_type",
        "value - 1.0D AS fare_amount",
        "CAST(i % 3 AS DOUBLE) / 2.0D AS extra",
        "0.5D AS mta_tax",
        f"CASE WHEN i % {NULL_TIP_MOD} = 0 THEN CAST(NULL AS DOUBLE) ELSE quarter_of_17 END AS tip_amount",
        f"CASE WHEN i % {TOLLS_MOD} = 0 THEN {TOLLS_VALUE}D ELSE 0.0D END AS tolls_amount",
        "1.0D AS improvement_surcharge",
        "value + quarter_of_17 AS total_amount",
        "2.5D AS congestion_surcharge",
        f"CASE WHEN i % {AIRPORT_FEE_MOD} = 0 THEN {AIRPORT_FEE_VALUE}D ELSE 0.0D END AS Airport_fee",
    )


def raw_zones_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """raw.zones layout: nation key as location id, region name as borough."""
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"], "inner").select(
        nation["n_nationkey"].cast("int").alias("location_id"),
        region["r_name"].alias("borough"),
        nation["n_name"].alias("zone"),
        F.lit("Yellow Zone").alias("service_zone"),
    )


# Declared schemas of the input tables used here: no inference job, no footer reads
# on the driver (at scale inference touches every file footer).
INPUT_SCHEMAS = {
    "events": T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("ts", T.TimestampNTZType()),
            T.StructField("user_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.DoubleType()),
            T.StructField("props", T.StringType()),
        ]
    ),
    "nation": T.StructType(
        [
            T.StructField("n_nationkey", T.IntegerType()),
            T.StructField("n_name", T.StringType()),
            T.StructField("n_regionkey", T.IntegerType()),
        ]
    ),
    "region": T.StructType(
        [T.StructField("r_regionkey", T.IntegerType()), T.StructField("r_name", T.StringType())]
    ),
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in INPUT_SCHEMAS:
        reader = reader.schema(INPUT_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trips_from_events(read_table(spark, sf_dir, "events"))


def raw_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_zones_from_nations(read_table(spark, sf_dir, "nation"), read_table(spark, sf_dir, "region"))
