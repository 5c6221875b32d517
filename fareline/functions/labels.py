"""Readable labels for pickup hour and payment code (O-34, O-35).

Both are CASE expressions generated from the fixed label tables below and built
as one SQL expression each (arguments are column names).
"""

from __future__ import annotations

from pyspark.sql import Column

from fareline.functions.sql import expr, quote, sql_literal
from fareline.schemas import PAYMENT_METHODS, SEGMENT_HOURS, TIME_OF_DAY_SEGMENTS


def time_of_day_segment_sql(ts: str) -> str:
    hour = f"hour({quote(ts)})"
    arms = " ".join(
        f"WHEN {hour} BETWEEN {lo} AND {hi} THEN {sql_literal(label)}"
        for (lo, hi), label in zip(SEGMENT_HOURS, TIME_OF_DAY_SEGMENTS, strict=False)
    )
    return f"CASE {arms} ELSE {sql_literal(TIME_OF_DAY_SEGMENTS[-1])} END"


def payment_method_sql(code: str) -> str:
    """Codes 1..6 map to the first six labels; 0, NULL and anything else give the last."""
    arms = " ".join(f"WHEN {i} THEN {sql_literal(label)}" for i, label in enumerate(PAYMENT_METHODS[:-1], start=1))
    return f"CASE {quote(code)} {arms} ELSE {sql_literal(PAYMENT_METHODS[-1])} END"


def time_of_day_segment(ts: str) -> Column:
    return expr(time_of_day_segment_sql(ts))


def payment_method(code: str) -> Column:
    return expr(payment_method_sql(code))
