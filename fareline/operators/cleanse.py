"""Cleansing: dedup, validity rules, derived measures, rejects and audit (O-20..O-33, O-72, O-73).

Order kept from the reference: dedup, then month window and time order, then
physical checks, then duration, then speed. All rules are row-local, so the
clean set equals the conjunction; the order only defines which rule a rejected
row is charged to (``rejects_by_rule``). A comparison with NULL rejects the row.

Catalyst pushes the key-column predicates (pickup, dropoff, locations, fare)
below the dedup window and into the Parquet scan; the non-key ones (distance,
total) stay above it, which is required: filtering before dedup would change
the survivor.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.functions.measures import avg_speed_mph, default_passengers, duration_minutes, tip_percentage
from fareline.operators.dedup import keep_first
from fareline.schemas import CLEANSE_DEDUP_KEYS

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# --- Fixed cleansing limits (as enforced by the reference code) -------------
MAX_DISTANCE_MILES = 150.0  # 0 < distance <= 150
MIN_DURATION_MIN = 1.0  # 1 <= rounded duration <= 720
MAX_DURATION_MIN = 720.0
MAX_SPEED_MPH = 100.0  # rounded speed <= 100
# ---------------------------------------------------------------------------


def month_window(year: int, month: int) -> tuple[str, str]:
    """Inclusive pickup window: first day 00:00:00 up to the *next* month's first day 23:59:59."""
    start = _dt.datetime(year, month, 1)
    nxt = _dt.datetime(year + 1, 1, 1) if month == 12 else _dt.datetime(year, month + 1, 1)
    end = nxt.replace(hour=23, minute=59, second=59)
    fmt = "%Y-%m-%d %H:%M:%S"
    return start.strftime(fmt), end.strftime(fmt)


@dataclass(frozen=True)
class Rule:
    name: str
    sql: Callable[[str, int, int], str]  # (pickup column type, year, month) -> predicate that KEEPS the row

    def build(self, df: DataFrame, year: int, month: int) -> Column:
        return F.expr(self.sql(_pickup_type(df), year, month))


def _pickup_type(df: DataFrame) -> str:
    """SQL type of the pickup column, so the window literals match it (NTZ or session-zone)."""
    return df.schema[PICKUP].dataType.simpleString()


def _in_month(ts_type: str, year: int, month: int) -> str:
    s, e = month_window(year, month)
    return (
        f"{PICKUP} >= CAST('{s}' AS {ts_type}) AND {PICKUP} <= CAST('{e}' AS {ts_type})"
    )


RULES: list[Rule] = [
    Rule("month_window", _in_month),
    Rule("temporal_order", lambda t, y, m: f"{DROPOFF} > {PICKUP}"),
    Rule("distance", lambda t, y, m: f"trip_distance > 0.0D AND trip_distance <= {MAX_DISTANCE_MILES}D"),
    Rule("fares", lambda t, y, m: "fare_amount > 0.0D AND total_amount > 0.0D"),
    Rule("locations", lambda t, y, m: "PULocationID IS NOT NULL AND DOLocationID IS NOT NULL"),
    Rule(
        "duration_range",
        lambda t, y, m: f"trip_duration_minutes >= {MIN_DURATION_MIN}D AND trip_duration_minutes <= {MAX_DURATION_MIN}D",
    ),
    Rule("speed_cap", lambda t, y, m: f"avg_speed_mph <= {MAX_SPEED_MPH}D"),
]
RULE_NAMES = [r.name for r in RULES]
DUPLICATE = "duplicate"


def dedup_raw(raw: DataFrame) -> DataFrame:
    """O-20: one row per (vendor, pickup, dropoff, PU, DO, fare)."""
    return keep_first(raw, CLEANSE_DEDUP_KEYS)


def with_measures(df: DataFrame) -> DataFrame:
    """O-30, O-31: rounded duration, then speed on the rounded duration."""
    return df.withColumn("trip_duration_minutes", duration_minutes(PICKUP, DROPOFF)).withColumn(
        "avg_speed_mph", avg_speed_mph("trip_distance", "trip_duration_minutes")
    )


def finish(df: DataFrame) -> DataFrame:
    """O-32, O-33: tip percentage and passenger default (column keeps its position)."""
    return df.withColumn("tip_percentage", tip_percentage("tip_amount", "fare_amount")).withColumn(
        "passenger_count", default_passengers("passenger_count")
    )


def rule_filter(df: DataFrame, names: list[str], year: int, month: int) -> DataFrame:
    """Apply the named rules in catalogue order (used by the single-rule queries)."""
    t = _pickup_type(df)
    by_name = {r.name: r for r in RULES}
    return df.where(" AND ".join(f"({by_name[n].sql(t, year, month)})" for n in names))


def cleanse(raw: DataFrame, year: int = 2024, month: int = 1) -> DataFrame:
    """O-28: the complete cleanse. Pure: no actions, no IO."""
    d = with_measures(dedup_raw(raw))
    return finish(rule_filter(d, RULE_NAMES, year, month))


def rejection_reason(df: DataFrame, year: int, month: int) -> Column:
    """First failing rule of a deduplicated row with measures; NULL when the row is kept."""
    t = _pickup_type(df)
    arms = " ".join(f"WHEN NOT coalesce(({r.sql(t, year, month)}), false) THEN '{r.name}'" for r in RULES)
    return F.expr(f"CASE {arms} END")


def rejects_by_rule(raw: DataFrame, year: int = 2024, month: int = 1) -> DataFrame:
    """O-29: rows removed per rule (duplicates first), zero rows included.

    Columns: rule_order int, rule string, rejected_rows bigint. Two global
    aggregates (raw count; reason counts after dedup), each partial per task.
    """
    deduped = with_measures(dedup_raw(raw))
    reason = rejection_reason(deduped, year, month)
    reason_counts = deduped.select(reason.alias("reason")).agg(
        *[F.count(F.when(F.col("reason") == n, 1)).alias(n) for n in RULE_NAMES],
        F.count(F.lit(1)).alias("__deduped"),
    )
    raw_count = raw.agg(F.count(F.lit(1)).alias("__raw"))
    both = merge_one_row(reason_counts, raw_count)
    entries = [F.struct(F.lit(0).alias("rule_order"), F.lit(DUPLICATE).alias("rule"),
                        (F.col("__raw") - F.col("__deduped")).alias("rejected_rows"))]
    entries += [
        F.struct(F.lit(i).alias("rule_order"), F.lit(n).alias("rule"), F.col(n).cast("bigint").alias("rejected_rows"))
        for i, n in enumerate(RULE_NAMES, start=1)
    ]
    return both.select(F.inline(F.array(*entries)))


def merge_one_row(*frames: DataFrame) -> DataFrame:
    """Combine one-row frames with disjoint columns into one row (no cross join).

    Each frame is widened with NULLs for the other columns, unioned by name, and
    collapsed with ``max`` (each column is non-NULL in exactly one input row).
    """
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out.agg(*[F.max(c).alias(c) for c in out.columns])


def clean_condition(df: DataFrame, year: int, month: int) -> Column:
    """All rules at once; NULL comparisons count as failures."""
    t = _pickup_type(df)
    return F.expr(" AND ".join(f"coalesce(({r.sql(t, year, month)}), false)" for r in RULES))


def audit_metrics(raw: DataFrame, year: int = 2024, month: int = 1) -> DataFrame:
    """O-72 + O-73 as one row.

    initial_rows, deduplicated_rows, duplicates_removed, clean_rows, dropped_rows
    (= initial - clean, includes duplicates) and dropped_percentage (unrounded;
    0.0 for an empty input). One dedup shuffle: the clean count is a conditional
    count over the deduplicated rows; the raw count is a separate narrow pass.
    """
    deduped = with_measures(dedup_raw(raw))
    one = merge_one_row(
        raw.agg(F.count(F.lit(1)).alias("initial_rows")),
        deduped.agg(
            F.count(F.lit(1)).alias("deduplicated_rows"),
            F.count(F.when(clean_condition(deduped, year, month), 1)).alias("clean_rows"),
        ),
    )
    dropped = F.col("initial_rows") - F.col("clean_rows")
    return one.select(
        "initial_rows",
        "deduplicated_rows",
        (F.col("initial_rows") - F.col("deduplicated_rows")).alias("duplicates_removed"),
        "clean_rows",
        dropped.alias("dropped_rows"),
        F.when(F.col("initial_rows") > 0, dropped.cast("double") / F.col("initial_rows") * 100.0)
        .otherwise(F.lit(0.0))
        .alias("dropped_percentage"),
    )


def audit_from_counts(initial: int, deduplicated: int | None, clean: int) -> dict:
    """The reference's metrics dict, plus the duplicates removed when that count was taken."""
    dropped = initial - clean
    return {
        "initial_rows": initial,
        "clean_rows": clean,
        "dropped_rows": dropped,
        "dropped_percentage": (dropped / initial) * 100 if initial > 0 else 0.0,
        "duplicates_removed": None if deduplicated is None else initial - deduplicated,
    }
