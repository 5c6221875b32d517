"""Date parts, weekday names and the weekend flag (O-36, O-38..O-40). Arguments are column names."""

from __future__ import annotations

from pyspark.sql import Column

from fareline.functions.sql import expr, quote


def is_weekend_sql(ts_or_date: str) -> str:
    # dayofweek: 1 = Sunday .. 7 = Saturday, locale free. (The short dayname gives 'Sat',
    # so testing a lower-cased name against 'saturday' would never match.) NULL in, NULL out.
    return f"(dayofweek({quote(ts_or_date)}) IN (1, 7))"


def is_weekend(ts_or_date: str) -> Column:
    """Saturday or Sunday."""
    return expr(is_weekend_sql(ts_or_date))


def pickup_date(ts: str) -> Column:
    """Calendar day of a timestamp as DATE (zone free on TIMESTAMP_NTZ)."""
    return expr(f"to_date({quote(ts)})")


def weekday_name(d: str) -> Column:
    """Full English weekday name, e.g. 'Saturday'."""
    return expr(f"date_format({quote(d)}, 'EEEE')")


def _int_part(fn: str, d: str) -> Column:
    return expr(f"CAST({fn}({quote(d)}) AS INT)")


def year_of(d: str) -> Column:
    return _int_part("year", d)


def month_of(d: str) -> Column:
    return _int_part("month", d)


def day_of_month(d: str) -> Column:
    return _int_part("dayofmonth", d)


def quarter_of(d: str) -> Column:
    return _int_part("quarter", d)


def iso_week(d: str) -> Column:
    """ISO-8601 week number (2024-12-30 is week 1)."""
    return _int_part("weekofyear", d)


def calendar_parts(d: str) -> list[Column]:
    """The eight dim_date attributes of a DATE column, in dimension order."""
    return [
        expr(f"{quote(d)} AS date_day"),
        year_of(d).alias("year"),
        month_of(d).alias("month"),
        day_of_month(d).alias("day_of_month"),
        quarter_of(d).alias("quarter"),
        weekday_name(d).alias("day_of_week"),
        is_weekend(d).alias("is_weekend"),
        iso_week(d).alias("iso_week"),
    ]
