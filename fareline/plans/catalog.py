"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Every query starts from the driver's tables (``events``, ``nation``,
``region``) through the fixture mapping, so its work grows with them. The sink
queries write through the real writers into the session's shared checkpoint
folder and read the result back.
"""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Callable
from dataclasses import replace
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareline import sinks
from fareline.functions import (
    avg_speed_mph,
    calendar_parts,
    default_passengers,
    duration_minutes,
    is_weekend,
    payment_method,
    pickup_date,
    time_of_day_segment,
    tip_percentage,
    trip_surrogate_key,
    weekday_name,
)
from fareline.operators import cleanse as C
from fareline.operators.lookups import lookup
from fareline.operators import keyfilter as K
from fareline.operators import models as M
from fareline.operators import partials as P
from fareline.operators import quality as Q
from fareline.operators import reports as R
from fareline.plans.materialize import put
from fareline.schemas import LAYERS, TRIP_KEY_PARTS
from fareline.session import scratch_path
from fareline.sinks import snapshots
from fareline.sinks.snapshots import Run, Warehouse, key
from fareline.sources import MonthSource, date_spine_between, read_landed, read_month, read_trips, read_zones_csv
from fareline.sources.testdata import raw_trips, raw_zones

Query = Callable[[SparkSession, str], DataFrame]
YEAR, MONTH = 2024, 1
PICKUP, DROPOFF = C.PICKUP, C.DROPOFF


def _clean(spark, d, year=YEAR, month=MONTH):
    return C.cleanse(raw_trips(spark, d), year, month)


class _Models:
    """The six models over the mapped tables, each built on first use (no size-check job
    for the zone lookups unless a query needs the enriched layer)."""

    def __init__(self, spark: SparkSession, d: str):
        self.spark, self.d = spark, d

    @cached_property
    def stg_trips(self) -> DataFrame:
        return M.stg_trips(_clean(self.spark, self.d))

    @cached_property
    def trips(self) -> DataFrame:
        """stg_trips with the derived columns; the reports need no zone lookup."""
        return M.trips_without_zones(self.stg_trips)

    @cached_property
    def rules(self) -> dict[str, DataFrame]:
        """Frames for the data tests."""
        return M.rule_frames(self.stg_trips, self.stg_zones)

    @cached_property
    def stg_zones(self) -> DataFrame:
        return M.stg_zones(raw_zones(self.spark, self.d))

    @cached_property
    def int_trips_enriched(self) -> DataFrame:
        return M.int_trips_enriched(self.stg_trips, self.stg_zones)

    @cached_property
    def fct_trips(self) -> DataFrame:
        return M.fct_trips(self.int_trips_enriched)

    @cached_property
    def dim_zones(self) -> DataFrame:
        return M.dim_zones(self.stg_zones)

    @cached_property
    def dim_date(self) -> DataFrame:
        return M.dim_date(self.spark)

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self, name)


def _models(spark, d) -> _Models:
    return _Models(spark, d)


def _stage(i: int, year=YEAR, month=MONTH) -> Query:
    def q(spark, d):
        measured = C.with_measures(C.dedup_raw(raw_trips(spark, d)))
        return C.rule_filter(measured, C.RULE_NAMES[:i], year, month)

    return q


# --- sources -------------------------------------------------------------------------------


def scan_trips(spark, d):
    return raw_trips(spark, d)


def scan_month(spark, d):
    """O-05: land the mapping as ``yellow_tripdata_2024-01.parquet`` and select it by month."""
    base = scratch_path(spark, "landing")
    src = MonthSource(base, YEAR, MONTH, "yellow")
    raw_trips(spark, d).write.mode("overwrite").parquet(src.path)
    return read_month(spark, src)


def _as_green(trips: DataFrame) -> DataFrame:
    """The mapping with the column names of a green file, and its own columns."""
    named = trips.withColumnsRenamed({PICKUP: "lpep_pickup_datetime", DROPOFF: "lpep_dropoff_datetime"})
    return named.drop("Airport_fee").withColumns({"ehail_fee": F.lit(None).cast("double"), "trip_type": F.lit(1.0)})


def scan_month_green(spark, d):
    """O-05: a green month file, read in the yellow layout (it has no airport fee)."""
    src = MonthSource(scratch_path(spark, "landing"), YEAR, MONTH, "green")
    _as_green(raw_trips(spark, d)).write.parquet(src.path)
    return read_landed(spark, src.path)


def scan_drifted(spark, d):
    """O-01/O-02: a folder whose parts differ: wider integers and another case, codes as doubles, instants
    instead of wall-clock times, a missing column."""
    base, raw = scratch_path(spark, "landing"), raw_trips(spark, d)
    part = F.coalesce(F.col("payment_type"), F.lit(0)) % 3
    wide = raw.where(part == 0).withColumnsRenamed({"Airport_fee": "airport_fee"})
    wide = wide.withColumns({c: F.col(c).cast("bigint") for c in ("VendorID", "PULocationID", "DOLocationID")})
    loose = raw.where(part == 1).withColumns({"RatecodeID": F.col("RatecodeID").cast("double"), "payment_type": F.col("payment_type").cast("double"), "VendorID": F.col("VendorID").cast("smallint")})
    utc = {c: F.convert_timezone(F.lit("UTC"), F.current_timezone(), c).cast("timestamp") for c in (PICKUP, DROPOFF)}
    instants = raw.where(part == 2).withColumns(utc).drop("congestion_surcharge")
    for name, df in (("a", wide), ("b", loose), ("c", instants)):
        df.write.parquet(f"{base}/{name}")
    return read_landed(spark, base)


def month_job_green(spark, d):
    """O-05/O-90: a green month through the whole job."""
    from fareline.plans.month_job import MonthJob, build_month

    job = MonthJob(warehouse=scratch_path(spark, "warehouse"), landing=scratch_path(spark, "landing"), taxi_type="green", fail_on_test_error=False)
    _as_green(raw_trips(spark, d)).write.parquet(job.source())
    with _databases(spark) as prefix:
        build_month(spark, replace(job, prefix=prefix), zones=raw_zones(spark, d))
    return _run_month(_stored(spark, job, "marts", "fct_trips"))


def scan_zones(spark, d):
    return raw_zones(spark, d)


def scan_zones_csv(spark, d):
    """O-03: zones written as a headed CSV and read back through the CSV source."""
    path = scratch_path(spark, "zones_csv")
    raw_zones(spark, d).select(
        F.col("location_id").alias("LocationID"),
        F.col("borough").alias("Borough"),
        F.col("zone").alias("Zone"),
        "service_zone",
    ).write.mode("overwrite").option("header", True).csv(path)
    return read_zones_csv(spark, path)


def scan_zones_csv_reordered(spark, d):
    """O-03: another column order and an extra column; columns go by their header names."""
    path = scratch_path(spark, "zones_csv")
    raw_zones(spark, d).select(
        "service_zone",
        F.col("zone").alias("Zone"),
        F.lit("x").alias("note"),
        F.col("location_id").alias("LocationID"),
        F.col("borough").alias("Borough"),
    ).write.mode("overwrite").option("header", True).csv(path)
    return read_zones_csv(spark, path)


def scan_clean(spark, d):
    """O-02: a directory of part files read as one dataset."""
    path = scratch_path(spark, "clean_parts")
    sinks.export_parquet(_clean(spark, d), path)
    return read_trips(spark, path)


# --- sinks ---------------------------------------------------------------------------------


def roundtrip_clean(spark, d):
    """O-10: month-partitioned write, read back with partition pruning."""
    path = scratch_path(spark, "clean_layer")
    sinks.write_month(_clean(spark, d), path, YEAR, MONTH)
    return spark.read.parquet(path).where((F.col("year") == YEAR) & (F.col("month") == MONTH))


@contextlib.contextmanager
def _databases(spark, *layers):
    """Layer databases of one query call, under names of its own; only their catalogue entries go
    afterwards, the files stay for the frame that the query returns (``session.clear_scratch``)."""
    prefix = f"q{uuid.uuid4().hex[:10]}_"
    sinks.create_layer_schemas(spark, layers or None, location=scratch_path(spark, "catalog"), prefix=prefix)
    try:
        yield prefix
    finally:
        for layer in layers or LAYERS:
            spark.sql(f"DROP DATABASE IF EXISTS `{prefix}{LAYERS[layer]}` CASCADE")


def load_replace(spark, d):
    """O-11/O-12: replace a catalogue table twice; only the last load remains."""
    path, raw = scratch_path(spark, "raw_trips"), raw_trips(spark, d)
    with _databases(spark, "raw") as prefix:
        sinks.replace_table(C.cleanse(raw, 2023, 12), f"{prefix}raw.trips", path)
        sinks.replace_table(C.cleanse(raw, YEAR, MONTH), f"{prefix}raw.trips", path)
    return snapshots.read(spark, path)


def replace_snapshots(spark, d):
    """O-11: two loads of one table; each version keeps its rows, also for a frame made before the second load."""
    path, raw = scratch_path(spark, "raw_trips"), raw_trips(spark, d)
    first = snapshots.replace(C.cleanse(raw, 2023, 12), path)
    held = snapshots.read(spark, path).withColumn("version", F.lit(first))
    second = snapshots.replace(C.cleanse(raw, YEAR, MONTH), path)
    return held.unionByName(snapshots.read(spark, path).withColumn("version", F.lit(second)))


def mart_roundtrip(spark, d):
    """O-15: the fact table materialised as a table and read back."""
    path = scratch_path(spark, "fct_trips")
    with _databases(spark, "marts") as prefix:
        sinks.replace_table(_models(spark, d)["fct_trips"], f"{prefix}marts.fct_trips", path)
    return snapshots.read(spark, path)


def backfill_two_months(spark, d):
    """O-16: December then January, January re-run; month overwrite keeps both months."""
    path, raw = scratch_path(spark, "backfill"), raw_trips(spark, d)
    with _databases(spark, "raw") as prefix:
        for y, m in [(2023, 12), (2024, 1), (2024, 1)]:
            sinks.write_month_table(C.cleanse(raw, y, m), f"{prefix}raw.trips", path, y, m)
    return spark.read.parquet(path)


def _run_month_job(spark, d, months=((YEAR, MONTH),)):
    """O-90 end to end on the mapped tables; tables land under the shared scratch folder."""
    from fareline.plans.month_job import MonthJob, backfill

    job = MonthJob(warehouse=scratch_path(spark, "warehouse"), fail_on_test_error=False)
    raw, zones = raw_trips(spark, d), raw_zones(spark, d)
    with _databases(spark) as prefix:
        backfill(spark, replace(job, prefix=prefix), list(months), raw_for=lambda y, m: raw, zones=zones)
    return job


def _stored(spark, job, layer, name) -> DataFrame:
    return Warehouse(spark, job.warehouse).read(layer, name)


def _run_month(table: DataFrame) -> DataFrame:
    return table.where((F.col("year") == YEAR) & (F.col("month") == MONTH)).drop("year", "month")


def month_job_fct(spark, d):
    """The fact mart as the month job persisted it (run month partition)."""
    return _run_month(_stored(spark, _run_month_job(spark, d), "marts", "fct_trips"))


def int_roundtrip(spark, d):
    """O-15: the intermediate model as the month job stored it in its own layer."""
    return _run_month(_stored(spark, _run_month_job(spark, d), "intermediate", "int_trips_enriched"))


def month_job_report_top5(spark, d):
    """The top-5 report over the marts the month job persisted."""
    job = _run_month_job(spark, d)
    return R.report_top_boroughs(_run_month(_stored(spark, job, "marts", "fct_trips")), _stored(spark, job, "marts", "dim_zones"), 5)


def resume_from_clean(spark, d):
    """O-92: the models come from the stored clean layer, through a catalogue that never saw it."""
    from fareline.plans.month_job import build_month

    job = _run_month_job(spark, d)
    lost = (("marts", "fct_trips"), ("staging", "stg_trips"))
    Warehouse(spark, job.warehouse).commit({key(layer, name, YEAR, MONTH): None for layer, name in lost})
    with _databases(spark) as prefix:
        build_month(spark, replace(job, prefix=prefix, from_layer="clean"))
    return _run_month(_stored(spark, job, "marts", "fct_trips"))


TWO_MONTHS = ((2023, 12), (2024, 1))


def rebuild_two_months(spark, d):
    """O-94: every month of the clean layer is rebuilt."""
    from fareline.plans.month_job import rebuild_warehouse

    job = _run_month_job(spark, d, TWO_MONTHS)
    with _databases(spark) as prefix:
        rebuild_warehouse(spark, replace(job, prefix=prefix))
    return _stored(spark, job, "marts", "fct_trips")


def month_job_audited(spark, d):
    """O-87/O-90: January is published, December fails its tests; no layer shows December."""
    from fareline.plans.month_job import MONTH_TABLES, MonthJob, build_month

    job = MonthJob(warehouse=scratch_path(spark, "warehouse"), fail_on_test_error=False)
    raw, zones = raw_trips(spark, d), raw_zones(spark, d)
    with _databases(spark) as prefix:
        build_month(spark, replace(job, prefix=prefix), raw, zones)
        with contextlib.suppress(Q.DataTestFailure):
            build_month(spark, replace(job, prefix=prefix, year=2023, month=12, fail_on_test_error=True), raw, zones)
    stored = Warehouse(spark, job.warehouse)
    layers = [stored.read(*t).groupBy("year", "month").agg(F.count(F.lit(1)).alias("n")).select(F.lit(".".join(t)).alias("layer"), "year", "month", "n") for t in MONTH_TABLES[:4]]
    out = layers[0]
    for x in layers[1:]:
        out = out.unionByName(x)
    return out


def dq_unique_all_months(spark, d):
    """O-81 over a fact of six months through their key filters. The days of the mapped month stand for months
    (day of month modulo 6); trips that begin between 5 and 6 are planted a second time, five months apart."""
    fct = put(_models(spark, d)["fct_trips"], scratch_path(spark, "models"))
    at = F.dayofmonth("pickup_at") % 6 + 1
    again = fct.where("hour(pickup_at) = 5").withColumn("m", (at + 4) % 6 + 1)
    spread = fct.withColumn("m", at).unionByName(again)
    run = Run(Warehouse(spark, scratch_path(spark, "warehouse")))
    for m in range(1, 7):
        month = run.put(spread.where(F.col("m") == m).drop("m"), "marts", "fct_trips", YEAR, m)
        K.put_keys(run, month, "trip_id", "marts", "fct_trips", YEAR, m)
    run.publish()
    return K.unique_over_months(run.warehouse, "marts", "fct_trips", "trip_id")


def dq_unique_two_months(spark, d):
    """O-81 over a fact of two run months: trips of the first day of January belong to both."""
    return Q.unique_violations(_stored(spark, _run_month_job(spark, d, TWO_MONTHS), "marts", "fct_trips"), "trip_id")


# --- derived columns (row level over the raw mapping) ----------------------------------------


def derive_duration(spark, d):
    return raw_trips(spark, d).select(PICKUP, DROPOFF, duration_minutes(PICKUP, DROPOFF).alias("trip_duration_minutes"))


def derive_speed(spark, d):
    r = raw_trips(spark, d).select("trip_distance", duration_minutes(PICKUP, DROPOFF).alias("trip_duration_minutes"))
    return r.select("*", avg_speed_mph("trip_distance", "trip_duration_minutes").alias("avg_speed_mph"))


def derive_tip_pct(spark, d):
    return raw_trips(spark, d).select(
        "tip_amount", "fare_amount", tip_percentage("tip_amount", "fare_amount").alias("tip_percentage")
    )


def derive_passengers(spark, d):
    return raw_trips(spark, d).select(
        F.col("passenger_count").alias("raw_passenger_count"),
        default_passengers("passenger_count").alias("passenger_count"),
    )


def derive_segment(spark, d):
    return raw_trips(spark, d).select(PICKUP, time_of_day_segment(PICKUP).alias("time_of_day_segment"))


def derive_payment(spark, d):
    return raw_trips(spark, d).select("payment_type", payment_method("payment_type").alias("payment_method"))


def derive_weekend(spark, d):
    return raw_trips(spark, d).select(PICKUP, is_weekend(PICKUP).alias("is_weekend"))


def derive_pickup_date(spark, d):
    return raw_trips(spark, d).select(PICKUP, pickup_date(PICKUP).alias("pickup_date"))


def derive_weekday_name(spark, d):
    return raw_trips(spark, d).select(PICKUP, weekday_name(PICKUP).alias("day_of_week"))


def derive_calendar_parts(spark, d):
    return raw_trips(spark, d).select(pickup_date(PICKUP).alias("d")).select(*calendar_parts("d"))


def derive_trip_id(spark, d):
    parts = TRIP_KEY_PARTS
    return _clean(spark, d).select(trip_surrogate_key(*parts).alias("trip_id"), *parts)


# --- cleansing -------------------------------------------------------------------------------


def clean_dedup(spark, d):
    return C.dedup_raw(raw_trips(spark, d))


def clean_trips(spark, d):
    return _clean(spark, d)


def clean_trips_december(spark, d):
    return _clean(spark, d, 2023, 12)


def clean_rejects_by_rule(spark, d):
    return C.rejects_by_rule(raw_trips(spark, d), YEAR, MONTH)


def audit_metrics(spark, d):
    return C.audit_metrics(raw_trips(spark, d), YEAR, MONTH)


def audit_duplicates(spark, d):
    return audit_metrics(spark, d).select("initial_rows", "deduplicated_rows", "duplicates_removed")


# --- models ----------------------------------------------------------------------------------


def _model(name: str) -> Query:
    return lambda spark, d: _models(spark, d)[name]


def stg_dedup(spark, d):
    return M.staging_dedup(_clean(spark, d))


def dim_date_used(spark, d):
    """Calendar rows (default 2024 range) of the days that have trips (semi join on pre-aggregated days)."""
    m = _models(spark, d)
    days = m["fct_trips"].select("pickup_date").distinct()  # at most one row per day
    cal = m["dim_date"]
    return cal.join(days, cal["date_day"] == days["pickup_date"], "left_semi")


def date_spine_trips(spark, d):
    """O-06 driven by the data: one row per day from the first to the last pickup day of the fact."""
    bounds = _models(spark, d)["fct_trips"].agg(
        F.min("pickup_date").alias("start"), F.max("pickup_date").alias("end")
    )
    return date_spine_between(bounds)


def enrich_pickup_zone(spark, d):
    """O-62 alone: the pickup-role LEFT lookup (size-checked broadcast)."""
    m = _models(spark, d)
    zones = m["stg_zones"].selectExpr(
        "location_id AS __pu", "borough AS pickup_borough", "zone_name AS pickup_zone"
    )
    trips = m["stg_trips"].select("trip_id", "pickup_location_id")
    return lookup(trips, zones, "pickup_location_id", "__pu", "left")


def enrich_both_zones(spark, d):
    return _models(spark, d)["int_trips_enriched"].select(
        "trip_id", "pickup_location_id", "dropoff_location_id", "pickup_borough", "pickup_zone",
        "dropoff_borough", "dropoff_zone",
    )


# --- counts, KPIs, reports -------------------------------------------------------------------


def count_trips(spark, d):
    return R.count_rows(_clean(spark, d), "total_trips")


def count_zones(spark, d):
    return R.count_rows(raw_zones(spark, d), "zone_count")


def kpi_load(spark, d):
    return R.kpi_load(_clean(spark, d), raw_zones(spark, d))


def report_borough_revenue(spark, d):
    m = _models(spark, d)
    return R.report_borough_revenue(m.trips, m["dim_zones"])


def report_top5_boroughs(spark, d):
    m = _models(spark, d)
    return R.report_top_boroughs(m.trips, m["dim_zones"], 5)


def report_time_of_day(spark, d):
    return R.report_time_of_day(_models(spark, d).trips)


def report_weekend(spark, d):
    m = _models(spark, d)
    return R.report_weekend(m.trips, m["dim_date"])


def _two_months_of_partials(spark, d) -> DataFrame:
    """Partial aggregates of the fact, stored by month and read together."""
    run = Run(Warehouse(spark, scratch_path(spark, "warehouse")))
    zones = M.stg_zones(raw_zones(spark, d))
    for y, m in TWO_MONTHS:
        fct = M.fct_trips(M.int_trips_enriched(M.stg_trips(_clean(spark, d, y, m)), zones))
        run.put(P.trip_partials(fct), "marts", "fct_trips_partials", y, m)
    run.publish()
    return run.warehouse.read("marts", "fct_trips_partials")


def partials_top5_boroughs(spark, d):
    return P.report_top_boroughs(_two_months_of_partials(spark, d), M.dim_zones(M.stg_zones(raw_zones(spark, d))), 5)


def partials_time_of_day(spark, d):
    return P.report_time_of_day(_two_months_of_partials(spark, d))


def partials_weekend(spark, d):
    return P.report_weekend(_two_months_of_partials(spark, d), M.dim_date(spark))


def partials_kpis(spark, d):
    return P.report_kpis(_two_months_of_partials(spark, d))


# --- data quality ----------------------------------------------------------------------------


def dq_summary(spark, d):
    """O-87: the 40 rules over the staged trips, stored once in the shared folder."""
    stg = put(_models(spark, d)["stg_trips"], scratch_path(spark, "models"))
    return Q.summary(M.rule_frames(stg, M.stg_zones(raw_zones(spark, d))))


def _dirty_frames(spark, d) -> dict[str, DataFrame]:
    """Frames on which every kind of rule fails: trips staged without cleansing or dedup, labels outside
    the lists, a zone without a borough and a repeated one, which the lookups fan out."""
    stg = M.staged(C.finish(C.with_measures(raw_trips(spark, d))))
    zones = M.stg_zones(raw_zones(spark, d))
    zones = zones.unionByName(zones.where("location_id = 3")).withColumn("borough", F.expr("CASE WHEN location_id <> 5 THEN borough END"))
    enriched = M.int_trips_enriched(stg, zones).withColumns(
        {
            "payment_method": F.expr("CASE WHEN payment_method = 'Other' THEN concat('Code ', vendor_id) ELSE payment_method END"),
            "time_of_day_segment": F.expr("CASE WHEN hour(pickup_at) = 3 THEN 'Small Hours' WHEN hour(pickup_at) = 4 THEN NULL ELSE time_of_day_segment END"),
        }
    )
    return {"stg_trips": stg, "int_trips_enriched": enriched, "fct_trips": M.fct_trips(enriched), "stg_zones": zones, "dim_zones": M.dim_zones(zones)}


def dq_summary_dirty(spark, d):
    """O-87 where rules of every kind fail."""
    return Q.summary(_dirty_frames(spark, d))


def _dq_dirty(rule_id: str) -> Query:
    return lambda spark, d: Q.violations(Q.RULES_BY_ID[rule_id], _dirty_frames(spark, d))


def _dq_not_null(model: str) -> Query:
    def q(spark, d):
        rules = [r for r in Q.RULES if r.model == model and r.test == "not_null"]
        return Q.summary(_models(spark, d), rules).select("rule_id", "failing_rows")

    return q


def dq_not_null_footers(spark, d):
    """O-80/O-70 of the stored models from their file footers: no column is read."""
    from fareline.sources.footers import footer_session, null_counts

    path, m = scratch_path(spark, "models"), _models(spark, d)
    session, out = footer_session(spark), None
    stg = put(m["stg_trips"], f"{path}/stg_trips")
    fct = put(M.fct_trips(M.int_trips_enriched(stg, m["stg_zones"])), f"{path}/fct_trips")
    for name, df in (("stg_trips", stg), ("fct_trips", fct)):
        columns = [r.column for r in Q.RULES if r.model == name and r.test == "not_null"]
        found = null_counts(session, [f"{path}/{name}"], df.schema, columns)
        found = found.select(F.concat(F.lit(f"not_null_{name}_"), "column_name").alias("rule_id"), F.col("nulls").alias("failing_rows"))
        out = found if out is None else out.unionByName(found)
    return out


def dq_unique_trip_id(spark, d):
    return Q.unique_violations(_models(spark, d).rules["fct_trips"], "trip_id")


def dq_unique_location_id(spark, d):
    return Q.unique_violations(_models(spark, d)["dim_zones"], "location_id")


def dq_accepted_payment(spark, d):
    return Q.accepted_values_violations(_models(spark, d).rules["fct_trips"], "payment_method", Q.PAYMENT_VALUES)


def dq_accepted_segment(spark, d):
    return Q.accepted_values_violations(_models(spark, d).rules["int_trips_enriched"], "time_of_day_segment", Q.SEGMENT_VALUES)


def dq_rel_pickup_zone(spark, d):
    m = _models(spark, d).rules
    return Q.relationship_violations(m["fct_trips"], "pickup_location_id", m["dim_zones"], "location_id")


def _singular(rule_id: str, on_raw: bool) -> Query:
    def q(spark, d):
        if on_raw:
            # staged without cleansing: measures and defaults only, so the rules have cases
            stg = M.stg_trips(C.finish(C.with_measures(raw_trips(spark, d))))
        else:
            stg = _models(spark, d)["stg_trips"]
        return Q.violations(Q.RULES_BY_ID[rule_id], {"stg_trips": stg})

    return q


QUERIES: dict[str, Query] = {
    "scan_trips": scan_trips,
    "scan_month": scan_month,
    "scan_month_green": scan_month_green,
    "scan_drifted": scan_drifted,
    "scan_zones": scan_zones,
    "scan_zones_csv": scan_zones_csv,
    "scan_zones_csv_reordered": scan_zones_csv_reordered,
    "scan_clean": scan_clean,
    "clean_dedup": clean_dedup,
    "clean_month_window": _stage(1),
    "clean_temporal_order": _stage(2),
    "clean_distance": _stage(3),
    "clean_fares": _stage(4),
    "clean_locations": _stage(5),
    "clean_duration_range": _stage(6),
    "clean_speed_cap": _stage(7),
    "clean_month_window_december": _stage(1, 2023, 12),
    "clean_trips": clean_trips,
    "clean_trips_december": clean_trips_december,
    "clean_rejects_by_rule": clean_rejects_by_rule,
    "audit_metrics": audit_metrics,
    "audit_duplicates": audit_duplicates,
    "derive_duration": derive_duration,
    "derive_speed": derive_speed,
    "derive_tip_pct": derive_tip_pct,
    "derive_passengers": derive_passengers,
    "derive_segment": derive_segment,
    "derive_payment": derive_payment,
    "derive_weekend": derive_weekend,
    "derive_pickup_date": derive_pickup_date,
    "derive_weekday_name": derive_weekday_name,
    "derive_calendar_parts": derive_calendar_parts,
    "derive_trip_id": derive_trip_id,
    "stg_dedup": stg_dedup,
    "stg_trips": _model("stg_trips"),
    "stg_zones": _model("stg_zones"),
    "int_trips_enriched": _model("int_trips_enriched"),
    "fct_trips": _model("fct_trips"),
    "dim_zones": _model("dim_zones"),
    "dim_date_used": dim_date_used,
    "date_spine_trips": date_spine_trips,
    "enrich_pickup_zone": enrich_pickup_zone,
    "enrich_both_zones": enrich_both_zones,
    "roundtrip_clean": roundtrip_clean,
    "load_replace": load_replace,
    "replace_snapshots": replace_snapshots,
    "mart_roundtrip": mart_roundtrip,
    "backfill_two_months": backfill_two_months,
    "month_job_fct": month_job_fct,
    "month_job_report_top5": month_job_report_top5,
    "month_job_green": month_job_green,
    "int_roundtrip": int_roundtrip,
    "resume_from_clean": resume_from_clean,
    "rebuild_two_months": rebuild_two_months,
    "count_trips": count_trips,
    "count_zones": count_zones,
    "kpi_load": kpi_load,
    "report_borough_revenue": report_borough_revenue,
    "report_top5_boroughs": report_top5_boroughs,
    "report_time_of_day": report_time_of_day,
    "report_weekend": report_weekend,
    "partials_top5_boroughs": partials_top5_boroughs,
    "partials_time_of_day": partials_time_of_day,
    "partials_weekend": partials_weekend,
    "partials_kpis": partials_kpis,
    "dq_summary": dq_summary,
    "dq_summary_dirty": dq_summary_dirty,
    "month_job_audited": month_job_audited,
    "dq_unique_two_months": dq_unique_two_months,
    "dq_unique_all_months": dq_unique_all_months,
    "dq_unique_trip_id_dirty": _dq_dirty("unique_stg_trips_trip_id"),
    "dq_unique_fct_trip_id_dirty": _dq_dirty("unique_fct_trips_trip_id"),
    "dq_unique_location_id_dirty": _dq_dirty("unique_dim_zones_location_id"),
    "dq_accepted_payment_dirty": _dq_dirty("accepted_values_fct_trips_payment_method"),
    "dq_accepted_segment_dirty": _dq_dirty("accepted_values_int_trips_enriched_time_of_day_segment"),
    "dq_not_null_stg_trips": _dq_not_null("stg_trips"),
    "dq_not_null_fct_trips": _dq_not_null("fct_trips"),
    "dq_not_null_footers": dq_not_null_footers,
    "dq_unique_trip_id": dq_unique_trip_id,
    "dq_unique_location_id": dq_unique_location_id,
    "dq_accepted_payment": dq_accepted_payment,
    "dq_accepted_segment": dq_accepted_segment,
    "dq_rel_pickup_zone": dq_rel_pickup_zone,
    "dq_pickup_before_dropoff": _singular("assert_pickup_before_dropoff", False),
    "dq_positive_metrics": _singular("assert_positive_trip_metrics", False),
    "dq_pickup_before_dropoff_raw": _singular("assert_pickup_before_dropoff", True),
    "dq_positive_metrics_raw": _singular("assert_positive_trip_metrics", True),
}
