"""Trip measures derived during cleansing (O-30..O-33) and the surrogate key (O-37).

Arguments are column names; each function returns one SQL expression.
"""

from __future__ import annotations

from pyspark.sql import Column

from fareline.functions.sql import expr, quote


def duration_minutes_sql(pickup: str, dropoff: str) -> str:
    # unix_timestamp truncates each side to the second; on TIMESTAMP_NTZ it is zone-free.
    # 60.0D is a DOUBLE literal (plain 60.0 would be DECIMAL in SQL text).
    return f"round((unix_timestamp({quote(dropoff)}) - unix_timestamp({quote(pickup)})) / 60.0D, 2)"


def avg_speed_mph_sql(distance: str, duration_min: str) -> str:
    d = quote(duration_min)
    return f"CASE WHEN {d} > 0 THEN round({quote(distance)} / ({d} / 60.0D), 2) ELSE 0.0D END"


def tip_percentage_sql(tip: str, fare: str) -> str:
    f = quote(fare)
    return f"CASE WHEN {f} > 0 THEN round({quote(tip)} / {f} * 100.0D, 2) ELSE 0.0D END"


def default_passengers_sql(count: str) -> str:
    c = quote(count)
    return f"CASE WHEN {c} IS NULL OR {c} <= 0 THEN 1 ELSE try_cast({c} AS INT) END"


def trip_surrogate_key_sql(*parts: str) -> str:
    # concat (not concat_ws): any NULL part gives a NULL key, which not_null then reports
    pieces = ", '|', ".join(f"CAST({quote(p)} AS STRING)" for p in parts)
    return f"md5(concat({pieces}))"


def duration_minutes(pickup: str, dropoff: str) -> Column:
    """Whole-second epoch difference in minutes, rounded to 2 places (double)."""
    return expr(duration_minutes_sql(pickup, dropoff))


def avg_speed_mph(distance: str, duration_min: str) -> Column:
    """distance / hours on the *rounded* duration; 0.0 when the duration is not positive."""
    return expr(avg_speed_mph_sql(distance, duration_min))


def tip_percentage(tip: str, fare: str) -> Column:
    """tip / fare * 100 rounded to 2; 0.0 when fare is not positive; NULL tip stays NULL."""
    return expr(tip_percentage_sql(tip, fare))


def default_passengers(count: str) -> Column:
    """Missing or non-positive passenger counts become 1; others are cast to INT."""
    return expr(default_passengers_sql(count))


def trip_surrogate_key(*parts: str) -> Column:
    """md5 over the parts cast to text and joined by '|'."""
    return expr(trip_surrogate_key_sql(*parts))
