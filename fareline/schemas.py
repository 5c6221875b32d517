"""Declared schemas per layer, layer names and fixed label lists (O-13, O-88)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Layer name -> database name, used verbatim (no target prefix).
LAYERS = {
    "raw": "raw",
    "staging": "staging",
    "intermediate": "intermediate",
    "marts": "marts",
}

# Raw trip columns in file order (yellow taxi record layout).
RAW_TRIP_FIELDS = [
    ("VendorID", T.IntegerType()),
    ("tpep_pickup_datetime", T.TimestampNTZType()),
    ("tpep_dropoff_datetime", T.TimestampNTZType()),
    ("passenger_count", T.DoubleType()),
    ("trip_distance", T.DoubleType()),
    ("RatecodeID", T.IntegerType()),
    ("store_and_fwd_flag", T.StringType()),
    ("PULocationID", T.IntegerType()),
    ("DOLocationID", T.IntegerType()),
    ("payment_type", T.IntegerType()),
    ("fare_amount", T.DoubleType()),
    ("extra", T.DoubleType()),
    ("mta_tax", T.DoubleType()),
    ("tip_amount", T.DoubleType()),
    ("tolls_amount", T.DoubleType()),
    ("improvement_surcharge", T.DoubleType()),
    ("total_amount", T.DoubleType()),
    ("congestion_surcharge", T.DoubleType()),
    ("Airport_fee", T.DoubleType()),
]
RAW_TRIP_COLUMNS = [name for name, _ in RAW_TRIP_FIELDS]
TRIPS_RAW = T.StructType([T.StructField(n, t, True) for n, t in RAW_TRIP_FIELDS])

# Measures added by cleansing, appended after the raw columns.
DERIVED_MEASURES = ["trip_duration_minutes", "avg_speed_mph", "tip_percentage"]
TRIPS_CLEAN = T.StructType(
    [
        T.StructField(n, T.IntegerType() if n == "passenger_count" else t, True)
        for n, t in RAW_TRIP_FIELDS
    ]
    + [T.StructField(n, T.DoubleType(), True) for n in DERIVED_MEASURES]
)

# Dedup keys. The two dedups differ on purpose. A key is a set; the order below only
# sets the window's sort order: the pickup timestamp first gives the sort a
# discriminating prefix (VendorID first has two values and made the dedup ~30% slower).
CLEANSE_DEDUP_KEYS = [
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "fare_amount",
    "PULocationID",
    "DOLocationID",
    "VendorID",
]
STAGING_DEDUP_KEYS = [
    "tpep_pickup_datetime",
    "total_amount",
    "PULocationID",
    "DOLocationID",
    "passenger_count",
    "VendorID",
]

# Zone lookup CSV header and the loaded raw.zones layout.
ZONES_CSV = T.StructType(
    [
        T.StructField("LocationID", T.StringType(), True),
        T.StructField("Borough", T.StringType(), True),
        T.StructField("Zone", T.StringType(), True),
        T.StructField("service_zone", T.StringType(), True),
    ]
)
ZONES_RAW = T.StructType(
    [
        T.StructField("location_id", T.IntegerType(), True),
        T.StructField("borough", T.StringType(), True),
        T.StructField("zone", T.StringType(), True),
        T.StructField("service_zone", T.StringType(), True),
    ]
)

STG_ZONES = T.StructType(
    [
        T.StructField("location_id", T.IntegerType(), True),
        T.StructField("borough", T.StringType(), True),
        T.StructField("zone_name", T.StringType(), True),
        T.StructField("service_zone", T.StringType(), True),
    ]
)
DIM_ZONES = STG_ZONES


def _struct(spec: list[tuple[str, T.DataType]]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in spec])


_I, _D, _S = T.IntegerType(), T.DoubleType(), T.StringType()
_TS, _DT, _B = T.TimestampNTZType(), T.DateType(), T.BooleanType()

STG_TRIPS = _struct(
    [
        ("trip_id", _S),
        ("vendor_id", _I),
        ("pickup_location_id", _I),
        ("dropoff_location_id", _I),
        ("ratecode_id", _I),
        ("payment_type_code", _I),
        ("passenger_count", _I),
        ("store_and_fwd_flag", _S),
        ("pickup_at", _TS),
        ("dropoff_at", _TS),
        ("trip_distance_miles", _D),
        ("trip_duration_minutes", _D),
        ("avg_speed_mph", _D),
        ("fare_amount", _D),
        ("extra", _D),
        ("mta_tax", _D),
        ("tip_amount", _D),
        ("tolls_amount", _D),
        ("improvement_surcharge", _D),
        ("congestion_surcharge", _D),
        ("airport_fee", _D),
        ("total_amount", _D),
        ("tip_percentage", _D),
    ]
)

INT_TRIPS_ENRICHED = _struct(
    [
        ("trip_id", _S),
        ("vendor_id", _I),
        ("pickup_location_id", _I),
        ("dropoff_location_id", _I),
        ("pickup_at", _TS),
        ("dropoff_at", _TS),
        ("pickup_date", _DT),
        ("pickup_borough", _S),
        ("pickup_zone", _S),
        ("dropoff_borough", _S),
        ("dropoff_zone", _S),
        ("time_of_day_segment", _S),
        ("payment_method", _S),
        ("is_weekend", _B),
        ("passenger_count", _I),
        ("trip_distance_miles", _D),
        ("trip_duration_minutes", _D),
        ("avg_speed_mph", _D),
        ("fare_amount", _D),
        ("tip_amount", _D),
        ("tip_percentage", _D),
        ("tolls_amount", _D),
        ("congestion_surcharge", _D),
        ("airport_fee", _D),
        ("total_amount", _D),
    ]
)

FCT_TRIPS_COLUMNS = [
    "trip_id",
    "pickup_location_id",
    "dropoff_location_id",
    "pickup_date",
    "vendor_id",
    "time_of_day_segment",
    "payment_method",
    "is_weekend",
    "passenger_count",
    "pickup_borough",
    "pickup_zone",
    "dropoff_borough",
    "dropoff_zone",
    "pickup_at",
    "dropoff_at",
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
]
_INT_TYPES = {f.name: f.dataType for f in INT_TRIPS_ENRICHED.fields}
FCT_TRIPS = _struct([(n, _INT_TYPES[n]) for n in FCT_TRIPS_COLUMNS])

DIM_DATE = _struct(
    [
        ("date_day", _DT),
        ("year", _I),
        ("month", _I),
        ("day_of_month", _I),
        ("quarter", _I),
        ("day_of_week", _S),
        ("is_weekend", _B),
        ("iso_week", _I),
    ]
)

# --- Fixed values that must equal the reference's labels and layouts -------
# Time-of-day segments by pickup hour: 7-9, 10-15, 16-19, 20-23, everything else.
TIME_OF_DAY_SEGMENTS = [
    "Morning Rush",
    "Midday",
    "Evening Rush",
    "Night",
    "Late Night / Early Morning",
]
# First and last pickup hour of the first four segments (the fifth takes every other hour).
SEGMENT_HOURS = [(7, 9), (10, 15), (16, 19), (20, 23)]
# Payment codes 1..6 in order, then the fallback label for any other code.
PAYMENT_METHODS = [
    "Credit Card",
    "Cash",
    "No Charge",
    "Dispute",
    "Unknown",
    "Voided Trip",
    "Other",
]
# Default calendar range of the date dimension (inclusive).
CALENDAR_START = "2024-01-01"
CALENDAR_END = "2024-12-31"
# Staging projection: (raw column, type, staging name), in staging order after trip_id.
STG_TRIP_COLUMNS = [
    ("VendorID", "int", "vendor_id"),
    ("PULocationID", "int", "pickup_location_id"),
    ("DOLocationID", "int", "dropoff_location_id"),
    ("RatecodeID", "int", "ratecode_id"),
    ("payment_type", "int", "payment_type_code"),
    ("passenger_count", "int", "passenger_count"),
    ("store_and_fwd_flag", "string", "store_and_fwd_flag"),
    ("tpep_pickup_datetime", "timestamp_ntz", "pickup_at"),
    ("tpep_dropoff_datetime", "timestamp_ntz", "dropoff_at"),
    ("trip_distance", "double", "trip_distance_miles"),
    ("trip_duration_minutes", "double", "trip_duration_minutes"),
    ("avg_speed_mph", "double", "avg_speed_mph"),
    ("fare_amount", "double", "fare_amount"),
    ("extra", "double", "extra"),
    ("mta_tax", "double", "mta_tax"),
    ("tip_amount", "double", "tip_amount"),
    ("tolls_amount", "double", "tolls_amount"),
    ("improvement_surcharge", "double", "improvement_surcharge"),
    ("congestion_surcharge", "double", "congestion_surcharge"),
    ("Airport_fee", "double", "airport_fee"),
    ("total_amount", "double", "total_amount"),
    ("tip_percentage", "double", "tip_percentage"),
]
# Parts of the surrogate trip key, in order, joined by '|'.
TRIP_KEY_PARTS = ["VendorID", "tpep_pickup_datetime", "PULocationID", "DOLocationID", "total_amount", "passenger_count"]
# ---------------------------------------------------------------------------


class SchemaMismatch(ValueError):
    pass


def check_schema(df: DataFrame, expected: T.StructType, *, layer: str = "") -> DataFrame:
    """Contract check on names, order and types (nullability ignored). Returns df."""
    got = [(f.name, f.dataType) for f in df.schema.fields]
    want = [(f.name, f.dataType) for f in expected.fields]
    if got != want:
        raise SchemaMismatch(f"{layer or 'frame'} schema mismatch:\n got  {got}\n want {want}")
    return df
