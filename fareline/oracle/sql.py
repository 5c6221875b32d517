"""DuckDB SQL text of every registered query.

Written against the driver's pre-registered views. Conventions that make both
engines agree: every ORDER BY spells out ``NULLS LAST``; ``60.0`` and ``100.0``
are cast to DOUBLE (in SQL text they would be DECIMAL); integer results are cast
to the Spark type; the weekday test uses ``dayofweek`` (0 = Sunday).
"""

from __future__ import annotations

import datetime as _dt

from fareline.schemas import STG_TRIP_COLUMNS  # fixed column layout (data, not logic)

# --------------------------------------------------------------------------- raw mapping

RAW_CTES = """
ev AS (
    SELECT event_id AS i, ts, user_id, value FROM events
),
ev_copies AS (
    SELECT i, ts, user_id, value, 0 AS k FROM ev
    UNION ALL SELECT i, ts, user_id, value, 1 AS k FROM ev WHERE i % 101 = 0
    UNION ALL SELECT i, ts, user_id, value, 2 AS k FROM ev WHERE i % 103 = 0
    UNION ALL SELECT i, ts, user_id, value, 3 AS k FROM ev WHERE i % 107 = 0
),
ev_times AS (
    SELECT *,
        CASE WHEN i % 97 = 0 THEN date_trunc('second', ts) - INTERVAL 40 DAY
             ELSE date_trunc('second', ts) END AS pu_ts
    FROM ev_copies
),
raw_trips AS (
    SELECT
        CAST(1 + i % 2 AS INTEGER) AS VendorID,
        CAST(pu_ts AS TIMESTAMP) AS tpep_pickup_datetime,
        CAST(pu_ts + to_seconds(CAST((i * 37) % 60000 - 300 + CASE WHEN k = 2 THEN 60 ELSE 0 END AS BIGINT))
             AS TIMESTAMP) AS tpep_dropoff_datetime,
        CASE WHEN i % 11 = 0 THEN NULL ELSE CAST(i % 6 AS DOUBLE) END AS passenger_count,
        CAST((i * 13) % 16000 AS DOUBLE) / 100.0::DOUBLE
            + CASE WHEN k = 3 THEN 200.0::DOUBLE ELSE 0.0::DOUBLE END AS trip_distance,
        CAST(1 + i % 6 AS INTEGER) AS RatecodeID,
        CASE WHEN i % 29 = 0 THEN 'Y' ELSE 'N' END AS store_and_fwd_flag,
        CASE WHEN i % 53 = 0 THEN NULL ELSE CAST(user_id % 27 AS INTEGER) END AS PULocationID,
        CAST((user_id * 7 + i) % 25 AS INTEGER) AS DOLocationID,
        CAST(i % 8 AS INTEGER) AS payment_type,
        value - 1.0::DOUBLE AS fare_amount,
        CAST(i % 3 AS DOUBLE) / 2.0::DOUBLE AS extra,
        0.5::DOUBLE AS mta_tax,
        CASE WHEN i % 13 = 0 THEN NULL ELSE CAST(i % 17 AS DOUBLE) / 4.0::DOUBLE END AS tip_amount,
        CASE WHEN i % 19 = 0 THEN 6.94::DOUBLE ELSE 0.0::DOUBLE END AS tolls_amount,
        1.0::DOUBLE AS improvement_surcharge,
        value + CAST(i % 17 AS DOUBLE) / 4.0::DOUBLE AS total_amount,
        2.5::DOUBLE AS congestion_surcharge,
        CASE WHEN i % 23 = 0 THEN 1.75::DOUBLE ELSE 0.0::DOUBLE END AS Airport_fee
    FROM ev_times
),
zones_raw AS (
    SELECT CAST(n.n_nationkey AS INTEGER) AS location_id, r.r_name AS borough, n.n_name AS zone,
           'Yellow Zone' AS service_zone
    FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

RAW_COLS = [
    "VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "passenger_count", "trip_distance",
    "RatecodeID", "store_and_fwd_flag", "PULocationID", "DOLocationID", "payment_type", "fare_amount",
    "extra", "mta_tax", "tip_amount", "tolls_amount", "improvement_surcharge", "total_amount",
    "congestion_surcharge", "Airport_fee",
]
DEDUP1_KEYS = ["VendorID", "tpep_pickup_datetime", "tpep_dropoff_datetime", "PULocationID", "DOLocationID", "fare_amount"]  # noqa: E501
DEDUP2_KEYS = ["VendorID", "tpep_pickup_datetime", "PULocationID", "DOLocationID", "total_amount", "passenger_count"]
CLEAN_COLS = RAW_COLS + ["trip_duration_minutes", "avg_speed_mph", "tip_percentage"]


def _order(cols, keys):
    return ", ".join(f"{c} ASC NULLS LAST" for c in cols if c not in keys)


DUR_SQL = "round((floor(epoch(tpep_dropoff_datetime)) - floor(epoch(tpep_pickup_datetime))) / 60.0::DOUBLE, 2)"
SPEED_SQL = (
    "CASE WHEN trip_duration_minutes > 0 "
    "THEN round(trip_distance / (trip_duration_minutes / 60.0::DOUBLE), 2) ELSE 0.0::DOUBLE END"
)
TIP_SQL = "CASE WHEN fare_amount > 0 THEN round(tip_amount / fare_amount * 100.0::DOUBLE, 2) ELSE 0.0::DOUBLE END"
PAX_SQL = (
    "CASE WHEN passenger_count IS NULL OR passenger_count <= 0 THEN 1 "
    "ELSE CAST(passenger_count AS INTEGER) END"
)

CLEAN_BASE_CTES = f"""
clean_dedup AS (
    SELECT * EXCLUDE (_rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY {", ".join(DEDUP1_KEYS)}
            ORDER BY {_order(RAW_COLS, DEDUP1_KEYS)}) AS _rn
        FROM raw_trips)
    WHERE _rn = 1
),
dedup_dur AS (
    SELECT *, {DUR_SQL} AS trip_duration_minutes FROM clean_dedup
),
measured AS (
    SELECT *, {SPEED_SQL} AS avg_speed_mph FROM dedup_dur
)"""


def window_bounds(year: int, month: int) -> tuple[str, str]:
    nxt = _dt.date(year + 1, 1, 1) if month == 12 else _dt.date(year, month + 1, 1)
    return f"{year:04d}-{month:02d}-01 00:00:00", f"{nxt.isoformat()} 23:59:59"


def rule_sql(year: int, month: int) -> list[tuple[str, str]]:
    s, e = window_bounds(year, month)
    return [
        ("month_window", f"tpep_pickup_datetime >= TIMESTAMP '{s}' AND tpep_pickup_datetime <= TIMESTAMP '{e}'"),
        ("temporal_order", "tpep_dropoff_datetime > tpep_pickup_datetime"),
        ("distance", "trip_distance > 0 AND trip_distance <= 150"),
        ("fares", "fare_amount > 0 AND total_amount > 0"),
        ("locations", "PULocationID IS NOT NULL AND DOLocationID IS NOT NULL"),
        ("duration_range", "trip_duration_minutes >= 1.0 AND trip_duration_minutes <= 720.0"),
        ("speed_cap", "avg_speed_mph <= 100.0"),
    ]


def _where(year, month, upto=None):
    rules = rule_sql(year, month)
    if upto is not None:
        rules = rules[:upto]
    return " AND ".join(f"({p})" for _, p in rules)


def _finish_select(src: str, where: str = "") -> str:
    cols = []
    for c in RAW_COLS:
        cols.append(f"{PAX_SQL} AS passenger_count" if c == "passenger_count" else c)
    cols += ["trip_duration_minutes", "avg_speed_mph", f"{TIP_SQL} AS tip_percentage"]
    return f"SELECT {', '.join(cols)} FROM {src}" + (f" WHERE {where}" if where else "")


def clean_cte(name: str, year: int, month: int) -> str:
    return f"{name} AS ({_finish_select('measured', _where(year, month))})"


_SEGMENT_SQL = """CASE
            WHEN hour({c}) BETWEEN 7 AND 9 THEN 'Morning Rush'
            WHEN hour({c}) BETWEEN 10 AND 15 THEN 'Midday'
            WHEN hour({c}) BETWEEN 16 AND 19 THEN 'Evening Rush'
            WHEN hour({c}) BETWEEN 20 AND 23 THEN 'Night'
            ELSE 'Late Night / Early Morning' END"""
_PAYMENT_SQL = """CASE {c}
            WHEN 1 THEN 'Credit Card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No Charge'
            WHEN 4 THEN 'Dispute' WHEN 5 THEN 'Unknown' WHEN 6 THEN 'Voided Trip'
            ELSE 'Other' END"""
_WEEKEND_SQL = "(dayofweek({c}) IN (0, 6))"
_KEY_SQL = (
    "md5(CAST(VendorID AS VARCHAR) || '|' || CAST(tpep_pickup_datetime AS VARCHAR) || '|' || "
    "CAST(PULocationID AS VARCHAR) || '|' || CAST(DOLocationID AS VARCHAR) || '|' || "
    "CAST(total_amount AS VARCHAR) || '|' || CAST(passenger_count AS VARCHAR))"
)


_DUCK_TYPES = {"int": "INTEGER", "string": "VARCHAR", "timestamp_ntz": "TIMESTAMP", "double": "DOUBLE"}
_STG_SELECT = ",\n        ".join(f"CAST({src} AS {_DUCK_TYPES[t]}) AS {dst}" for src, t, dst in STG_TRIP_COLUMNS)


def staging_ctes(src: str, prefix: str = "") -> str:
    """stg dedup + stg_trips over a clean-shaped CTE ``src``."""
    p = prefix
    return f"""
{p}stg_dedup AS (
    SELECT * EXCLUDE (_rn) FROM (
        SELECT *, row_number() OVER (
            PARTITION BY {", ".join(DEDUP2_KEYS)}
            ORDER BY {_order(CLEAN_COLS, DEDUP2_KEYS)}) AS _rn
        FROM {src})
    WHERE _rn = 1
),
{p}stg_trips AS (
    SELECT
        {_KEY_SQL} AS trip_id,
        {_STG_SELECT}
    FROM {p}stg_dedup
)"""


FCT_COLS = [
    "trip_id", "pickup_location_id", "dropoff_location_id", "pickup_date", "vendor_id", "time_of_day_segment",
    "payment_method", "is_weekend", "passenger_count", "pickup_borough", "pickup_zone", "dropoff_borough",
    "dropoff_zone", "pickup_at", "dropoff_at", "trip_distance_miles", "trip_duration_minutes", "avg_speed_mph",
    "fare_amount", "tip_amount", "tip_percentage", "tolls_amount", "congestion_surcharge", "airport_fee",
    "total_amount",
]

def enrich_select(stg: str, more: str = "") -> str:
    return f"""
    SELECT
        t.trip_id, t.vendor_id, t.pickup_location_id, t.dropoff_location_id, t.pickup_at, t.dropoff_at,
        CAST(t.pickup_at AS DATE) AS pickup_date,
        pz.borough AS pickup_borough, pz.zone_name AS pickup_zone,
        dz.borough AS dropoff_borough, dz.zone_name AS dropoff_zone,
        {_SEGMENT_SQL.format(c="t.pickup_at")} AS time_of_day_segment,
        {_PAYMENT_SQL.format(c="t.payment_type_code")} AS payment_method,
        {_WEEKEND_SQL.format(c="t.pickup_at")} AS is_weekend,
        t.passenger_count, t.trip_distance_miles, t.trip_duration_minutes, t.avg_speed_mph,
        t.fare_amount, t.tip_amount, t.tip_percentage, t.tolls_amount, t.congestion_surcharge,
        t.airport_fee, t.total_amount{more}
    FROM {stg} t
    LEFT JOIN stg_zones pz ON t.pickup_location_id = pz.location_id
    LEFT JOIN stg_zones dz ON t.dropoff_location_id = dz.location_id
"""


ZONES_CTE = """
stg_zones AS (
    SELECT CAST(location_id AS INTEGER) AS location_id, CAST(borough AS VARCHAR) AS borough,
           CAST(zone AS VARCHAR) AS zone_name, CAST(service_zone AS VARCHAR) AS service_zone
    FROM zones_raw
)"""

MODEL_CTES = (
    staging_ctes("clean_trips")
    + ","
    + ZONES_CTE
    + f""",
int_trips_enriched AS ({enrich_select("stg_trips")}),
fct_trips AS (
    SELECT {", ".join(FCT_COLS)} FROM int_trips_enriched
),
dim_zones AS (
    SELECT location_id, borough, zone_name, service_zone FROM stg_zones
),
dim_date AS (
    SELECT
        CAST(d AS DATE) AS date_day,
        CAST(year(d) AS INTEGER) AS year,
        CAST(month(d) AS INTEGER) AS month,
        CAST(day(d) AS INTEGER) AS day_of_month,
        CAST(quarter(d) AS INTEGER) AS quarter,
        strftime(d, '%A') AS day_of_week,
        {_WEEKEND_SQL.format(c="d")} AS is_weekend,
        CAST(weekofyear(d) AS INTEGER) AS iso_week
    FROM generate_series(TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-12-31 00:00:00', INTERVAL 1 DAY) AS g(d)
)"""
)


def with_ctes(body: str, *blocks: str) -> str:
    return "WITH " + ",".join(b.strip("\n") for b in blocks) + "\n" + body


def over_raw(body: str) -> str:
    return with_ctes(body, RAW_CTES)


def over_measured(body: str) -> str:
    return with_ctes(body, RAW_CTES, CLEAN_BASE_CTES)


def over_clean(body: str, year: int = 2024, month: int = 1) -> str:
    return with_ctes(body, RAW_CTES, CLEAN_BASE_CTES, "\n" + clean_cte("clean_trips", year, month))


def over_models(body: str) -> str:
    return with_ctes(body, RAW_CTES, CLEAN_BASE_CTES, "\n" + clean_cte("clean_trips", 2024, 1), MODEL_CTES)


# --------------------------------------------------------------------------- queries

ORACLE_SQL: dict[str, str] = {}

# sources
ORACLE_SQL["scan_trips"] = over_raw("SELECT * FROM raw_trips")
ORACLE_SQL["scan_month"] = over_raw("SELECT * FROM raw_trips")
ORACLE_SQL["scan_month_green"] = over_raw("SELECT * REPLACE (CAST(NULL AS DOUBLE) AS Airport_fee) FROM raw_trips")
ORACLE_SQL["scan_drifted"] = over_raw(
    "SELECT * REPLACE (CASE WHEN coalesce(payment_type, 0) % 3 <> 2 THEN congestion_surcharge END AS congestion_surcharge) FROM raw_trips"
)
ORACLE_SQL["scan_zones"] = over_raw("SELECT * FROM zones_raw")
ORACLE_SQL["scan_zones_csv"] = over_raw("SELECT * FROM zones_raw")
ORACLE_SQL["scan_clean"] = over_clean("SELECT * FROM clean_trips")

# cleansing funnel
ORACLE_SQL["clean_dedup"] = over_measured("SELECT * FROM clean_dedup")
_STAGES = ["clean_month_window", "clean_temporal_order", "clean_distance", "clean_fares", "clean_locations",
           "clean_duration_range", "clean_speed_cap"]
for _i, _name in enumerate(_STAGES, start=1):
    ORACLE_SQL[_name] = over_measured(f"SELECT * FROM measured WHERE {_where(2024, 1, _i)}")
ORACLE_SQL["clean_month_window_december"] = over_measured(f"SELECT * FROM measured WHERE {_where(2023, 12, 1)}")
ORACLE_SQL["clean_trips"] = over_clean("SELECT * FROM clean_trips")
ORACLE_SQL["clean_trips_december"] = over_clean("SELECT * FROM clean_trips", 2023, 12)

_REASON = "CASE " + " ".join(
    f"WHEN NOT coalesce(({p}), false) THEN '{n}'" for n, p in rule_sql(2024, 1)
) + " END"
ORACLE_SQL["clean_rejects_by_rule"] = with_ctes(
    f"""
SELECT CAST(0 AS INTEGER) AS rule_order, 'duplicate' AS rule,
       CAST((SELECT count(*) FROM raw_trips) - (SELECT count(*) FROM clean_dedup) AS BIGINT) AS rejected_rows
UNION ALL
SELECT CAST(l.rule_order AS INTEGER), l.rule, CAST(count(r.reason) AS BIGINT)
FROM rule_list l LEFT JOIN reasons r ON r.reason = l.rule
GROUP BY l.rule_order, l.rule""",
    RAW_CTES,
    CLEAN_BASE_CTES,
    f"""
reasons AS (SELECT {_REASON} AS reason FROM measured),
rule_list AS (
    SELECT * FROM (VALUES (1, 'month_window'), (2, 'temporal_order'), (3, 'distance'), (4, 'fares'),
                          (5, 'locations'), (6, 'duration_range'), (7, 'speed_cap')) AS t(rule_order, rule)
)""",
)

_AUDIT_COUNTS = """
SELECT
    (SELECT count(*) FROM raw_trips) AS initial_rows,
    (SELECT count(*) FROM clean_dedup) AS deduplicated_rows,
    (SELECT count(*) FROM clean_trips) AS clean_rows
"""
ORACLE_SQL["audit_metrics"] = over_clean(
    f"""
SELECT CAST(initial_rows AS BIGINT) AS initial_rows,
       CAST(deduplicated_rows AS BIGINT) AS deduplicated_rows,
       CAST(initial_rows - deduplicated_rows AS BIGINT) AS duplicates_removed,
       CAST(clean_rows AS BIGINT) AS clean_rows,
       CAST(initial_rows - clean_rows AS BIGINT) AS dropped_rows,
       CASE WHEN initial_rows > 0
            THEN CAST(initial_rows - clean_rows AS DOUBLE) / initial_rows * 100.0::DOUBLE
            ELSE 0.0::DOUBLE END AS dropped_percentage
FROM ({_AUDIT_COUNTS}) c"""
)
ORACLE_SQL["audit_duplicates"] = over_measured(
    """
SELECT CAST(a AS BIGINT) AS initial_rows, CAST(b AS BIGINT) AS deduplicated_rows,
       CAST(a - b AS BIGINT) AS duplicates_removed
FROM (SELECT (SELECT count(*) FROM raw_trips) AS a, (SELECT count(*) FROM clean_dedup) AS b) c"""
)

# derived columns, row level over the raw mapping
ORACLE_SQL["derive_duration"] = over_raw(
    f"SELECT tpep_pickup_datetime, tpep_dropoff_datetime, {DUR_SQL} AS trip_duration_minutes FROM raw_trips"
)
ORACLE_SQL["derive_speed"] = over_raw(
    f"""SELECT trip_distance, trip_duration_minutes, {SPEED_SQL} AS avg_speed_mph
FROM (SELECT trip_distance, {DUR_SQL} AS trip_duration_minutes FROM raw_trips) t"""
)
ORACLE_SQL["derive_tip_pct"] = over_raw(f"SELECT tip_amount, fare_amount, {TIP_SQL} AS tip_percentage FROM raw_trips")
ORACLE_SQL["derive_passengers"] = over_raw(
    f"SELECT passenger_count AS raw_passenger_count, {PAX_SQL} AS passenger_count FROM raw_trips"
)
ORACLE_SQL["derive_segment"] = over_raw(
    f"SELECT tpep_pickup_datetime, {_SEGMENT_SQL.format(c='tpep_pickup_datetime')} AS time_of_day_segment FROM raw_trips"
)
ORACLE_SQL["derive_payment"] = over_raw(
    f"SELECT payment_type, {_PAYMENT_SQL.format(c='payment_type')} AS payment_method FROM raw_trips"
)
ORACLE_SQL["derive_weekend"] = over_raw(
    f"SELECT tpep_pickup_datetime, {_WEEKEND_SQL.format(c='tpep_pickup_datetime')} AS is_weekend FROM raw_trips"
)
ORACLE_SQL["derive_pickup_date"] = over_raw(
    "SELECT tpep_pickup_datetime, CAST(tpep_pickup_datetime AS DATE) AS pickup_date FROM raw_trips"
)
ORACLE_SQL["derive_weekday_name"] = over_raw(
    "SELECT tpep_pickup_datetime, strftime(tpep_pickup_datetime, '%A') AS day_of_week FROM raw_trips"
)
ORACLE_SQL["derive_calendar_parts"] = over_raw(
    f"""
SELECT d AS date_day, CAST(year(d) AS INTEGER) AS year, CAST(month(d) AS INTEGER) AS month,
       CAST(day(d) AS INTEGER) AS day_of_month, CAST(quarter(d) AS INTEGER) AS quarter,
       strftime(d, '%A') AS day_of_week, {_WEEKEND_SQL.format(c='d')} AS is_weekend,
       CAST(weekofyear(d) AS INTEGER) AS iso_week
FROM (SELECT CAST(tpep_pickup_datetime AS DATE) AS d FROM raw_trips) t"""
)
ORACLE_SQL["derive_trip_id"] = over_clean(
    f"SELECT {_KEY_SQL} AS trip_id, VendorID, tpep_pickup_datetime, PULocationID, DOLocationID, total_amount, "
    "passenger_count FROM clean_trips"
)

# models
ORACLE_SQL["stg_dedup"] = over_models("SELECT * FROM stg_dedup")
ORACLE_SQL["stg_trips"] = over_models("SELECT * FROM stg_trips")
ORACLE_SQL["stg_zones"] = over_models("SELECT * FROM stg_zones")
ORACLE_SQL["int_trips_enriched"] = over_models("SELECT * FROM int_trips_enriched")
ORACLE_SQL["fct_trips"] = over_models("SELECT * FROM fct_trips")
ORACLE_SQL["dim_zones"] = over_models("SELECT * FROM dim_zones")
ORACLE_SQL["dim_date_used"] = over_models(
    "SELECT * FROM dim_date WHERE date_day IN (SELECT pickup_date FROM fct_trips)"
)
ORACLE_SQL["date_spine_trips"] = over_models(
    """SELECT CAST(d AS DATE) AS date_day
FROM (SELECT min(pickup_date) AS lo, max(pickup_date) AS hi FROM fct_trips) b,
     generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(d)"""
)
ORACLE_SQL["enrich_pickup_zone"] = over_models(
    """SELECT t.trip_id, t.pickup_location_id, z.borough AS pickup_borough, z.zone_name AS pickup_zone
FROM stg_trips t LEFT JOIN stg_zones z ON t.pickup_location_id = z.location_id"""
)
ORACLE_SQL["enrich_both_zones"] = over_models(
    """SELECT trip_id, pickup_location_id, dropoff_location_id, pickup_borough, pickup_zone,
       dropoff_borough, dropoff_zone FROM int_trips_enriched"""
)

# sinks (round trips through storage)
ORACLE_SQL["roundtrip_clean"] = over_clean(
    "SELECT *, CAST(2024 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month FROM clean_trips"
)
ORACLE_SQL["load_replace"] = over_clean("SELECT * FROM clean_trips")
ORACLE_SQL["mart_roundtrip"] = over_models("SELECT * FROM fct_trips")
ORACLE_SQL["month_job_fct"] = over_models("SELECT * FROM fct_trips")
ORACLE_SQL["backfill_two_months"] = with_ctes(
    """
SELECT *, CAST(2023 AS INTEGER) AS year, CAST(12 AS INTEGER) AS month FROM clean_dec
UNION ALL
SELECT *, CAST(2024 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month FROM clean_jan""",
    RAW_CTES,
    CLEAN_BASE_CTES,
    "\n" + clean_cte("clean_dec", 2023, 12),
    "\n" + clean_cte("clean_jan", 2024, 1),
)

ORACLE_SQL["int_roundtrip"] = over_models("SELECT * FROM int_trips_enriched")
ORACLE_SQL["resume_from_clean"] = ORACLE_SQL["month_job_fct"]
_AIRPORT_FEE = "CASE WHEN i % 23 = 0 THEN 1.75::DOUBLE ELSE 0.0::DOUBLE END AS Airport_fee"
assert _AIRPORT_FEE in RAW_CTES
ORACLE_SQL["month_job_green"] = ORACLE_SQL["month_job_fct"].replace(_AIRPORT_FEE, "CAST(NULL AS DOUBLE) AS Airport_fee")
ORACLE_SQL["scan_zones_csv_reordered"] = ORACLE_SQL["scan_zones_csv"]


def over_two_months(body: str) -> str:
    """``fct`` over the run months 2023-12 and 2024-01, with year and month."""
    months = (("dec", 2023, 12), ("jan", 2024, 1))
    return with_ctes(
        body,
        RAW_CTES,
        CLEAN_BASE_CTES,
        *(f"\n{clean_cte(f'clean_{n}', y, m)}" for n, y, m in months),
        *(staging_ctes(f"clean_{n}", prefix=f"{n}_") for n, _, _ in months),
        "stg_both AS ("
        + " UNION ALL ".join(f"SELECT *, CAST({y} AS INTEGER) AS year, CAST({m} AS INTEGER) AS month FROM {n}_stg_trips" for n, y, m in months)
        + ")",
        ZONES_CTE,
        f"both_enriched AS ({enrich_select('stg_both', ', t.year, t.month')})",
        f"fct AS (SELECT {', '.join(FCT_COLS)}, year, month FROM both_enriched)",
    )


ORACLE_SQL["rebuild_two_months"] = over_two_months("SELECT * FROM fct")
ORACLE_SQL["dq_unique_two_months"] = over_two_months(
    "SELECT trip_id AS unique_field, CAST(count(*) AS BIGINT) AS n_records FROM fct "
    "WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING count(*) > 1"
)

ORACLE_SQL["replace_snapshots"] = with_ctes(
    "SELECT *, CAST(1 AS INTEGER) AS version FROM clean_dec UNION ALL SELECT *, CAST(2 AS INTEGER) AS version FROM clean_jan",
    RAW_CTES,
    CLEAN_BASE_CTES,
    *(f"\n{clean_cte(f'clean_{n}', y, m)}" for n, y, m in (("dec", 2023, 12), ("jan", 2024, 1))),
)
ORACLE_SQL["month_job_audited"] = over_models(
    "\nUNION ALL\n".join(
        f"SELECT '{layer}' AS layer, CAST(2024 AS INTEGER) AS year, CAST(1 AS INTEGER) AS month, CAST(count(*) AS BIGINT) AS n FROM {cte}"
        for layer, cte in (("raw.trips", "clean_trips"), ("staging.stg_trips", "stg_trips"), ("intermediate.int_trips_enriched", "int_trips_enriched"), ("marts.fct_trips", "fct_trips"))
    )
)
ORACLE_SQL["dq_unique_all_months"] = over_models(
    "SELECT trip_id AS unique_field, CAST(count(*) AS BIGINT) AS n_records FROM "
    "(SELECT trip_id FROM fct_trips UNION ALL SELECT trip_id FROM fct_trips WHERE hour(pickup_at) = 5) t "
    "WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING count(*) > 1"
)

# counts, KPIs and reports
ORACLE_SQL["count_trips"] = over_clean("SELECT CAST(count(*) AS BIGINT) AS total_trips FROM clean_trips")
ORACLE_SQL["count_zones"] = over_raw("SELECT CAST(count(*) AS BIGINT) AS zone_count FROM zones_raw")
ORACLE_SQL["kpi_load"] = over_clean(
    """
SELECT CAST(count(*) AS BIGINT) AS trips_loaded,
       (SELECT CAST(count(*) AS BIGINT) FROM zones_raw) AS zones_loaded,
       round(sum(total_amount), 2) AS total_revenue,
       round(avg(trip_distance), 2) AS avg_distance,
       round(avg(trip_duration_minutes), 2) AS avg_duration
FROM clean_trips"""
)
_BOROUGH = """
SELECT z.borough, CAST(count(*) AS BIGINT) AS total_trips,
       round(sum(f.total_amount), 2) AS total_revenue_usd,
       round(avg(f.tip_percentage), 2) AS avg_tip_pct
FROM fct_trips f JOIN dim_zones z ON f.pickup_location_id = z.location_id
GROUP BY z.borough"""
ORACLE_SQL["report_borough_revenue"] = over_models(_BOROUGH)
ORACLE_SQL["report_top5_boroughs"] = over_models(
    _BOROUGH + "\nORDER BY total_revenue_usd DESC NULLS LAST, z.borough ASC NULLS LAST\nLIMIT 5"
)
ORACLE_SQL["month_job_report_top5"] = ORACLE_SQL["report_top5_boroughs"]
ORACLE_SQL["report_time_of_day"] = over_models(
    """
SELECT time_of_day_segment, CAST(count(*) AS BIGINT) AS trip_count,
       round(avg(trip_distance_miles), 2) AS avg_distance_miles,
       round(avg(fare_amount), 2) AS avg_fare_usd
FROM fct_trips GROUP BY time_of_day_segment
ORDER BY trip_count DESC, time_of_day_segment ASC NULLS LAST"""
)
ORACLE_SQL["report_weekend"] = over_models(
    """
SELECT d.is_weekend, CAST(count(*) AS BIGINT) AS trip_count,
       round(avg(f.trip_distance_miles), 2) AS avg_distance,
       round(avg(f.total_amount), 2) AS avg_total_fare
FROM fct_trips f JOIN dim_date d ON f.pickup_date = d.date_day
GROUP BY d.is_weekend"""
)

# the same reports over two stored months of partial aggregates
ORACLE_SQL["partials_top5_boroughs"] = over_two_months(
    _BOROUGH.replace("fct_trips", "fct").replace("dim_zones", "stg_zones")
    + "\nORDER BY total_revenue_usd DESC NULLS LAST, z.borough ASC NULLS LAST\nLIMIT 5"
)
ORACLE_SQL["partials_time_of_day"] = over_two_months(
    "SELECT time_of_day_segment, CAST(count(*) AS BIGINT) AS trip_count, round(avg(trip_distance_miles), 2) AS avg_distance_miles, "
    "round(avg(fare_amount), 2) AS avg_fare_usd FROM fct GROUP BY time_of_day_segment"
)
ORACLE_SQL["partials_weekend"] = over_two_months(
    "SELECT is_weekend, CAST(count(*) AS BIGINT) AS trip_count, round(avg(trip_distance_miles), 2) AS avg_distance, "
    "round(avg(total_amount), 2) AS avg_total_fare FROM fct WHERE year(pickup_date) = 2024 GROUP BY is_weekend"
)
ORACLE_SQL["partials_kpis"] = over_two_months(
    "SELECT CAST(count(*) AS BIGINT) AS trips, round(sum(total_amount), 2) AS total_revenue, round(avg(trip_distance_miles), 2) AS avg_distance, "
    "round(avg(trip_duration_minutes), 2) AS avg_duration FROM fct"
)

# --------------------------------------------------------------------------- data tests


def _rule_count_sql(rule) -> str:
    """One SELECT yielding (rule_id, model, column_name, test, failing_rows) for a rule."""
    head = f"SELECT '{rule.rule_id}' AS rule_id, '{rule.model}' AS model, '{rule.column}' AS column_name, '{rule.test}' AS test, "
    col, model = rule.column, rule.model
    if rule.test == "not_null":
        return head + f"CAST(count(*) AS BIGINT) AS failing_rows FROM {model} WHERE {col} IS NULL"
    if rule.test == "unique":
        return head + (
            f"CAST(count(*) AS BIGINT) AS failing_rows FROM "
            f"(SELECT {col} FROM {model} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1) u"
        )
    if rule.test == "accepted_values":
        vals = ", ".join("'" + v.replace("'", "''") + "'" for v in rule.values)
        return head + (
            f"CAST(count(*) AS BIGINT) AS failing_rows FROM "
            f"(SELECT {col} AS v FROM {model} GROUP BY {col}) a WHERE v NOT IN ({vals})"
        )
    if rule.test == "relationships":
        return head + (
            f"CAST(count(*) AS BIGINT) AS failing_rows FROM {model} c WHERE c.{col} IS NOT NULL AND NOT EXISTS "
            f"(SELECT 1 FROM {rule.to_model} p WHERE p.{rule.to_column} = c.{col})"
        )
    if rule.test == "expression":
        return head + f"CAST(count(*) AS BIGINT) AS failing_rows FROM {model} WHERE {SINGULAR_SQL[rule.rule_id]}"
    raise ValueError(rule.test)


SINGULAR_SQL = {
    "assert_pickup_before_dropoff": "pickup_at >= dropoff_at",
    "assert_positive_trip_metrics": (
        "trip_distance_miles <= 0 OR fare_amount <= 0 OR total_amount <= 0 OR trip_duration_minutes <= 0"
    ),
}


def _summary_sql(rules) -> str:
    parts = "\nUNION ALL\n".join(_rule_count_sql(r) for r in rules)
    return (
        "SELECT rule_id, model, column_name, test, failing_rows, "
        "CASE WHEN failing_rows = 0 THEN 'pass' ELSE 'fail' END AS status FROM (\n" + parts + "\n) s"
    )


def _dq_queries():
    from fareline.operators.quality import RULES  # rule catalogue (data), not the Spark evaluation

    out = {}
    out["dq_summary"] = over_models(_summary_sql(RULES))
    for model in ("stg_trips", "fct_trips"):
        rules = [r for r in RULES if r.model == model and r.test == "not_null"]
        out[f"dq_not_null_{model}"] = over_models(
            "SELECT rule_id, failing_rows FROM (" + _summary_sql(rules) + ") q"
        )
    both = [r for r in RULES if r.model in ("stg_trips", "fct_trips") and r.test == "not_null"]
    out["dq_not_null_footers"] = over_models("SELECT rule_id, failing_rows FROM (" + _summary_sql(both) + ") q")
    out["dq_unique_trip_id"] = over_models(
        "SELECT trip_id AS unique_field, CAST(count(*) AS BIGINT) AS n_records FROM fct_trips "
        "WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING count(*) > 1"
    )
    out["dq_unique_location_id"] = over_models(
        "SELECT location_id AS unique_field, CAST(count(*) AS BIGINT) AS n_records FROM dim_zones "
        "WHERE location_id IS NOT NULL GROUP BY location_id HAVING count(*) > 1"
    )
    pay = ", ".join(f"'{v}'" for v in ["Credit Card", "Cash", "No Charge", "Dispute", "Unknown", "Voided Trip", "Other"])
    seg = ", ".join(
        f"'{v}'" for v in ["Morning Rush", "Midday", "Evening Rush", "Night", "Late Night / Early Morning"]
    )
    out["dq_accepted_payment"] = over_models(
        "SELECT value_field, n_records FROM (SELECT payment_method AS value_field, CAST(count(*) AS BIGINT) AS n_records "
        f"FROM fct_trips GROUP BY payment_method) a WHERE value_field NOT IN ({pay})"
    )
    out["dq_accepted_segment"] = over_models(
        "SELECT value_field, n_records FROM (SELECT time_of_day_segment AS value_field, CAST(count(*) AS BIGINT) AS "
        f"n_records FROM int_trips_enriched GROUP BY time_of_day_segment) a WHERE value_field NOT IN ({seg})"
    )
    out["dq_rel_pickup_zone"] = over_models(
        "SELECT c.pickup_location_id AS from_field FROM fct_trips c WHERE c.pickup_location_id IS NOT NULL "
        "AND NOT EXISTS (SELECT 1 FROM dim_zones p WHERE p.location_id = c.pickup_location_id)"
    )
    out["dq_pickup_before_dropoff"] = over_models(
        f"SELECT trip_id, pickup_at, dropoff_at FROM stg_trips WHERE {SINGULAR_SQL['assert_pickup_before_dropoff']}"
    )
    out["dq_positive_metrics"] = over_models(
        "SELECT trip_id, trip_distance_miles, fare_amount, total_amount, trip_duration_minutes FROM stg_trips "
        f"WHERE {SINGULAR_SQL['assert_positive_trip_metrics']}"
    )
    # The singular tests over the *uncleansed* mapping, staged the same way, where they do fail.
    raw_stage = with_ctes(
        "{body}",
        RAW_CTES,
        f"""
raw_dur AS (SELECT *, {DUR_SQL} AS trip_duration_minutes FROM raw_trips),
raw_measured AS (SELECT *, {SPEED_SQL} AS avg_speed_mph FROM raw_dur),
raw_finished AS ({_finish_select('raw_measured')})""",
        staging_ctes("raw_finished", prefix="raw_"),
    )
    out["dq_pickup_before_dropoff_raw"] = raw_stage.replace(
        "{body}",
        f"SELECT trip_id, pickup_at, dropoff_at FROM raw_stg_trips WHERE {SINGULAR_SQL['assert_pickup_before_dropoff']}",
    )
    out["dq_positive_metrics_raw"] = raw_stage.replace(
        "{body}",
        "SELECT trip_id, trip_distance_miles, fare_amount, total_amount, trip_duration_minutes FROM raw_stg_trips "
        f"WHERE {SINGULAR_SQL['assert_positive_trip_metrics']}",
    )
    dirty = with_ctes(
        "{body}",
        RAW_CTES,
        f"""
raw_dur AS (SELECT *, {DUR_SQL} AS trip_duration_minutes FROM raw_trips),
raw_measured AS (SELECT *, {SPEED_SQL} AS avg_speed_mph FROM raw_dur),
raw_finished AS ({_finish_select('raw_measured')}),
stg_trips AS (SELECT {_KEY_SQL} AS trip_id, {_STG_SELECT} FROM raw_finished),
stg_zones AS (
    SELECT location_id, CASE WHEN location_id <> 5 THEN borough END AS borough, zone AS zone_name, service_zone
    FROM (SELECT * FROM zones_raw UNION ALL SELECT * FROM zones_raw WHERE location_id = 3)),
joined AS ({enrich_select("stg_trips")}),
int_trips_enriched AS (
    SELECT * REPLACE (
        CASE WHEN payment_method = 'Other' THEN 'Code ' || vendor_id ELSE payment_method END AS payment_method,
        CASE WHEN hour(pickup_at) = 3 THEN 'Small Hours' WHEN hour(pickup_at) = 4 THEN NULL
             ELSE time_of_day_segment END AS time_of_day_segment)
    FROM joined),
fct_trips AS (SELECT {", ".join(FCT_COLS)} FROM int_trips_enriched),
dim_zones AS (SELECT * FROM stg_zones)""",
    )
    out["dq_summary_dirty"] = dirty.replace("{body}", _summary_sql(RULES))
    for name, column, model in (("trip", "trip_id", "stg_trips"), ("fct_trip", "trip_id", "fct_trips"), ("location", "location_id", "dim_zones")):
        out[f"dq_unique_{name}_id_dirty"] = dirty.replace(
            "{body}",
            f"SELECT {column} AS unique_field, CAST(count(*) AS BIGINT) AS n_records FROM {model} "
            f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1",
        )
    labels = (("payment", "payment_method", "fct_trips", pay), ("segment", "time_of_day_segment", "int_trips_enriched", seg))
    for name, column, model, listed in labels:
        out[f"dq_accepted_{name}_dirty"] = dirty.replace(
            "{body}",
            f"SELECT {column} AS value_field, CAST(count(*) AS BIGINT) AS n_records FROM {model} "
            f"WHERE {column} NOT IN ({listed}) GROUP BY {column}",
        )
    return out


ORACLE_SQL.update(_dq_queries())
