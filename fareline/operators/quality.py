"""Data-quality rules: the 40 model tests, their failing rows and a summary (O-77, O-80..O-87).

Each rule yields a DataFrame of violations (empty = pass) with the usual
generic-test semantics:

* ``not_null``          rows where the column is NULL
* ``unique``            one row per non-NULL value seen more than once (value, n_records)
* ``accepted_values``   one row per distinct value outside the list (NULL passes)
* ``relationships``     child rows whose non-NULL key has no parent row
* ``expression``        rows matching a singular-test predicate, with chosen columns

``summary`` reads every distinct frame once for all its not_null, expression, accepted_values and
relationships rules (``_one_read``) and once, as 64-bit hashes, for its unique rules
(``_unique_counts``).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fareline.functions.sql import quote, sql_literal
from fareline.operators.lookups import MAX_BROADCAST_ROWS, maybe_broadcast, orphans
from fareline.session import shared_dir, together
from fareline.schemas import PAYMENT_METHODS, TIME_OF_DAY_SEGMENTS


@dataclass(frozen=True)
class Rule:
    test: str  # not_null | unique | accepted_values | relationships | expression
    model: str
    column: str
    values: tuple = ()
    to_model: str = ""
    to_column: str = ""
    predicate: str = ""  # SQL text of a singular (expression) rule's failure condition
    returns: tuple = ()
    name: str = ""

    @property
    def rule_id(self) -> str:
        if self.name:
            return self.name
        if self.test == "relationships":
            return f"relationships_{self.model}_{self.column}__{self.to_column}__{self.to_model}"
        return f"{self.test}_{self.model}_{self.column}"

    def condition_sql(self) -> str:
        """Row-level failure condition as SQL (not_null / expression only)."""
        if self.test == "not_null":
            return f"{quote(self.column)} IS NULL"
        if self.test == "expression":
            return f"coalesce(({self.predicate}), false)"
        raise ValueError(f"{self.test} is not a row-level rule")

    def condition(self) -> Column:
        return F.expr(self.condition_sql())


def _not_null(model: str, *cols: str) -> list[Rule]:
    return [Rule("not_null", model, c) for c in cols]


# --- Fixed values: failure conditions of the two singular rules, and the 40 rules ---
PICKUP_NOT_BEFORE_DROPOFF = "pickup_at >= dropoff_at"
NON_POSITIVE_METRIC = (
    "trip_distance_miles <= 0 OR fare_amount <= 0 OR total_amount <= 0 OR trip_duration_minutes <= 0"
)


SEGMENT_VALUES = tuple(TIME_OF_DAY_SEGMENTS)
PAYMENT_VALUES = tuple(PAYMENT_METHODS)

RULES: list[Rule] = [
    # stg_trips (10)
    Rule("unique", "stg_trips", "trip_id"),
    *_not_null(
        "stg_trips",
        "trip_id",
        "vendor_id",
        "pickup_at",
        "dropoff_at",
        "pickup_location_id",
        "dropoff_location_id",
        "trip_distance_miles",
        "fare_amount",
        "total_amount",
    ),
    # stg_zones (4)
    Rule("unique", "stg_zones", "location_id"),
    *_not_null("stg_zones", "location_id", "borough", "zone_name"),
    # int_trips_enriched (7)
    Rule("unique", "int_trips_enriched", "trip_id"),
    *_not_null("int_trips_enriched", "trip_id", "time_of_day_segment"),
    Rule("accepted_values", "int_trips_enriched", "time_of_day_segment", values=SEGMENT_VALUES),
    *_not_null("int_trips_enriched", "payment_method"),
    Rule("accepted_values", "int_trips_enriched", "payment_method", values=PAYMENT_VALUES),
    *_not_null("int_trips_enriched", "is_weekend"),
    # fct_trips (13)
    Rule("unique", "fct_trips", "trip_id"),
    *_not_null("fct_trips", "trip_id", "pickup_location_id"),
    Rule("relationships", "fct_trips", "pickup_location_id", to_model="dim_zones", to_column="location_id"),
    *_not_null(
        "fct_trips",
        "dropoff_location_id",
        "pickup_at",
        "dropoff_at",
        "fare_amount",
        "total_amount",
        "trip_distance_miles",
        "payment_method",
    ),
    Rule("accepted_values", "fct_trips", "payment_method", values=PAYMENT_VALUES),
    *_not_null("fct_trips", "time_of_day_segment"),
    # dim_zones (4)
    Rule("unique", "dim_zones", "location_id"),
    *_not_null("dim_zones", "location_id", "borough", "zone_name"),
    # singular tests on stg_trips (2)
    Rule(
        "expression",
        "stg_trips",
        "pickup_at",
        predicate=PICKUP_NOT_BEFORE_DROPOFF,
        returns=("trip_id", "pickup_at", "dropoff_at"),
        name="assert_pickup_before_dropoff",
    ),
    Rule(
        "expression",
        "stg_trips",
        "trip_distance_miles",
        predicate=NON_POSITIVE_METRIC,
        returns=("trip_id", "trip_distance_miles", "fare_amount", "total_amount", "trip_duration_minutes"),
        name="assert_positive_trip_metrics",
    ),
]
assert len(RULES) == 40, len(RULES)

RULES_BY_ID = {r.rule_id: r for r in RULES}


# --- violations (failing rows) -----------------------------------------------------------


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def unique_violations(df: DataFrame, column: str) -> DataFrame:
    """O-77/O-81: (value, n_records) for non-NULL values occurring more than once."""
    c = quote(column)
    return (
        df.where(f"{c} IS NOT NULL")
        .groupBy(F.expr(f"{c} AS unique_field"))
        .agg(F.expr("count(1) AS n_records"))
        .where("n_records > 1")
    )


def accepted_values_violations(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """O-82: (value, n_records) for each distinct value outside ``values``; NULL passes (NOT IN gives NULL)."""
    listed = ", ".join(sql_literal(v) for v in values)
    return (
        df.groupBy(F.expr(f"{quote(column)} AS value_field"))
        .agg(F.expr("count(1) AS n_records"))
        .where(f"value_field NOT IN ({listed})")
    )


def relationship_violations(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """O-66/O-83: child keys (one row per child row) without a parent."""
    return orphans(child.select(F.col(column).alias("from_field")), "from_field", parent, parent_column)


def expression_violations(df: DataFrame, rule: Rule) -> DataFrame:
    out = df.where(rule.condition())
    return out.select(*rule.returns) if rule.returns else out


def violations(rule: Rule, frames: dict[str, DataFrame]) -> DataFrame:
    df = frames[rule.model]
    if rule.test == "not_null":
        return not_null_violations(df, rule.column)
    if rule.test == "unique":
        return unique_violations(df, rule.column)
    if rule.test == "accepted_values":
        return accepted_values_violations(df, rule.column, rule.values)
    if rule.test == "relationships":
        return relationship_violations(df, rule.column, frames[rule.to_model], rule.to_column)
    if rule.test == "expression":
        return expression_violations(df, rule)
    raise ValueError(rule.test)


# --- summary -----------------------------------------------------------------------------


def _summary_row_sql(rule: Rule, failing_sql: str) -> str:
    """One summary row as a SQL struct (one JVM call per rule instead of one per field)."""
    return (
        f"named_struct('rule_id', {sql_literal(rule.rule_id)}, 'model', {sql_literal(rule.model)}, "
        f"'column_name', {sql_literal(rule.column)}, 'test', {sql_literal(rule.test)}, "
        f"'failing_rows', CAST({failing_sql} AS BIGINT))"
    )


def _count_frame(rule: Rule, frame: DataFrame, count_sql: str) -> DataFrame:
    return frame.agg(F.expr(f"{count_sql} AS __n")).selectExpr(
        f"inline(array({_summary_row_sql(rule, 'coalesce(__n, 0)')}))"
    )


def _one_read(df: DataFrame, rules: list[Rule], frames: dict[str, DataFrame], max_rows: int) -> list[DataFrame]:
    """Summary rows of all rules over one frame, but unique ones, from a single read of it.

    Row-level failures are counted per combination of the columns that the accepted_values and
    relationships rules look at. The counts (one row per combination) are checkpointed to the shared
    folder, and every rule is answered from them.
    """
    counted = [r for r in rules if r.test in ("not_null", "expression")]
    keys = list(dict.fromkeys(r.column for r in rules if r.test in ("accepted_values", "relationships")))
    sums = [F.expr("count(1) AS __n")]
    sums += [F.expr(f"count(CASE WHEN {r.condition_sql()} THEN 1 END) AS __r{i}") for i, r in enumerate(counted)]
    counts = df.groupBy(*keys).agg(*sums)
    if keys:
        shared_dir(df.sparkSession)  # checkpoint() writes to the shared checkpoint folder
        counts = counts.checkpoint(eager=True)
    out = []
    if counted:
        total = counts.agg(*(F.expr(f"coalesce(sum(__r{i}), 0) AS __r{i}") for i in range(len(counted))))
        rows = ", ".join(_summary_row_sql(r, f"__r{i}") for i, r in enumerate(counted))
        out.append(total.selectExpr(f"inline(array({rows}))"))
    for r in rules:
        if r.test == "accepted_values":
            listed = ", ".join(sql_literal(v) for v in r.values)
            out.append(_count_frame(r, counts.select(r.column).distinct().where(f"{quote(r.column)} NOT IN ({listed})"), "count(1)"))
        elif r.test == "relationships":
            child = counts.groupBy(F.col(r.column).alias("__k")).agg(F.sum("__n").alias("__rows"))
            out.append(_count_frame(r, orphans(child, "__k", frames[r.to_model], r.to_column, max_rows), "sum(__rows)"))
    return out


def _unique_counts(frames: dict[str, DataFrame], rules: list[Rule], max_rows: int) -> list[DataFrame]:
    """Failing-value counts of all unique rules, exact, shuffling 64-bit hashes instead of values.

    One shuffle of (tag, xxhash64(value)) covers every distinct (frame, column); rules over the
    same one share it. Hashes seen more than once are checkpointed (duplicates and rare collisions).
    Without any, every rule passes. Otherwise the rows with such a hash are grouped by their real
    value, so a collision never counts as a duplicate.
    """
    tags: dict[tuple[int, str], int] = {}
    for r in rules:
        tags.setdefault((id(frames[r.model]), r.column), len(tags))
    keyed = {}
    for r in rules:
        c = quote(r.column)
        keyed[tags[id(frames[r.model]), r.column]] = frames[r.model].where(f"{c} IS NOT NULL").select(
            F.expr(f"{c} AS unique_field"), F.expr(f"xxhash64({c}) AS __h")
        )
    tagged = None
    for tag, part in keyed.items():
        part = part.select(F.lit(tag).cast("byte").alias("__tag"), "__h")
        tagged = part if tagged is None else tagged.unionByName(part)
    repeated = tagged.groupBy("__tag", "__h").agg(F.expr("count(1) AS __n")).where("__n > 1").select("__tag", "__h")
    spark = tagged.sparkSession
    shared_dir(spark)
    repeated = repeated.checkpoint(eager=True)
    if repeated.isEmpty():
        return [spark.range(1).selectExpr(f"inline(array({_summary_row_sql(r, '0')}))") for r in rules]
    side = maybe_broadcast(repeated, max_rows)
    out = []
    for r in rules:
        tag = tags[id(frames[r.model]), r.column]
        hits = keyed[tag].withColumn("__tag", F.lit(tag).cast("byte")).join(side, ["__tag", "__h"], "left_semi")
        dupes = hits.groupBy("unique_field").agg(F.expr("count(1) AS n_records")).where("n_records > 1")
        out.append(_count_frame(r, dupes, "count(1)"))
    return out


def summary(
    frames: dict[str, DataFrame],
    rules: Sequence[Rule] = RULES,
    max_broadcast_rows: int = MAX_BROADCAST_ROWS,
    unique_over: dict[str, DataFrame] | None = None,
    known: dict[str, int] | None = None,
) -> DataFrame:
    """O-87: one row per rule: rule_id, model, column_name, test, failing_rows, status.

    Each distinct frame is read once for all its rules and once for its unique ones; models given as
    the same frame object share both. ``unique_over`` names wider frames for unique rules
    (a month's ids among those of its neighbours). ``known`` has the failing rows of rules that are
    answered already (NULL counts from file footers); their columns are not read.
    """
    spark = frames[rules[0].model].sparkSession
    answered = [r for r in rules if r.rule_id in (known or {})]
    rules = [r for r in rules if r.rule_id not in (known or {})]
    steps = []
    unique_rules = [r for r in rules if r.test == "unique"]
    if unique_rules:
        wide = {r.model: (unique_over or {}).get(r.model, frames[r.model]) for r in unique_rules}
        steps.append(lambda: _unique_counts(wide, unique_rules, max_broadcast_rows))
    by_frame: dict[int, list[Rule]] = {}
    for r in rules:
        if r.test != "unique":
            by_frame.setdefault(id(frames[r.model]), []).append(r)
    steps += [lambda mine=mine: _one_read(frames[mine[0].model], mine, frames, max_broadcast_rows) for mine in by_frame.values()]
    shared_dir(spark)  # once, before the steps use it side by side
    parts = [p for some in together(*steps) for p in some]
    if answered:
        rows = ", ".join(_summary_row_sql(r, str(int(known[r.rule_id]))) for r in answered)
        parts.append(spark.range(1).selectExpr(f"inline(array({rows}))"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("status", F.when(F.col("failing_rows") == 0, F.lit("pass")).otherwise(F.lit("fail")))


class DataTestFailure(RuntimeError):
    pass


def raise_on(results: Sequence[dict]) -> None:
    """Raise when any rule fails (the job stops like a failing test run); one row per rule."""
    failed = [r for r in results if r["failing_rows"] > 0]
    if failed:
        names = ", ".join(f"{r['rule_id']}={r['failing_rows']}" for r in failed)
        raise DataTestFailure(f"{len(failed)} data test(s) failed: {names}")
