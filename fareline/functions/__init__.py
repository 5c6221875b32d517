"""Column expressions. Every function returns a ``Column`` built from Spark
built-ins, so callers stay inside whole-stage codegen (no Python UDFs)."""

from fareline.functions.calendar import (
    calendar_parts,
    day_of_month,
    is_weekend,
    iso_week,
    month_of,
    pickup_date,
    quarter_of,
    weekday_name,
    year_of,
)
from fareline.functions.labels import payment_method, time_of_day_segment
from fareline.functions.measures import (
    avg_speed_mph,
    default_passengers,
    duration_minutes,
    tip_percentage,
    trip_surrogate_key,
)

__all__ = [
    "avg_speed_mph",
    "calendar_parts",
    "day_of_month",
    "default_passengers",
    "duration_minutes",
    "is_weekend",
    "iso_week",
    "month_of",
    "payment_method",
    "pickup_date",
    "quarter_of",
    "time_of_day_segment",
    "tip_percentage",
    "trip_surrogate_key",
    "weekday_name",
    "year_of",
]
