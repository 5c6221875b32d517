"""The month job: scan -> cleanse -> load -> model -> test (O-90..O-94).

One driver program, no subprocesses. Each layer is stored as a snapshot under the
job's warehouse folder, which both cuts lineage and lets a run resume from the
clean layer (``from_layer="clean"``) or rebuild the warehouse from it. A run stores
all its layers beside the published ones, tests what it stored, and then publishes
every table of the month with one commit. A month that fails its tests, or a run
that dies at any point, leaves every layer as it was; Spark's task retry covers
lost executors.

Audit counts are taken with ``observe`` during the clean write, so the dedup
shuffle runs once (the reference runs it for each of its four actions).
"""

from __future__ import annotations

import argparse
import hashlib
from dataclasses import dataclass, replace
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fareline import sinks
from fareline.operators import cleanse as C
from fareline.operators import keyfilter as K
from fareline.operators import models as M
from fareline.operators import partials as P
from fareline.operators import quality as Q
from fareline.operators import reports as R
from fareline.session import job_description, together
from fareline.sinks import layout
from fareline.sinks.snapshots import Run, Warehouse, check_location, key, register, schema_of
from fareline.schemas import (
    CALENDAR_END,
    CALENDAR_START,
    DIM_DATE,
    DIM_ZONES,
    FCT_TRIPS,
    INT_TRIPS_ENRICHED,
    STG_TRIPS,
    STG_ZONES,
    TRIPS_CLEAN,
    ZONES_RAW,
    check_schema,
)
from fareline.sources.files import TAXI_TYPES, MonthSource, read_zones_optional, table_name
from fareline.sources.footers import footer_session, null_counts
from fareline.sources.resolve import fingerprint, read_landed

LAYER_ORDER = ("raw", "clean")


@dataclass
class MonthJob:
    """Job parameters (O-93); ``from_args`` fills them from spark-submit arguments.

    ``warehouse`` is the shared folder that holds the layers. What exists there decides, not the
    session's catalogue: runs in other processes find and keep each other's months. A catalogue in
    which a table lies in another warehouse is refused. ``prefix`` is put before the database names
    (scratch runs beside each other). Raw trips come from ``raw_path``, or from the month's file in
    ``landing`` for ``taxi_type``; either is brought to one layout (``sources.resolve``). Green and yellow
    months are the same months: give each taxi type a warehouse and a prefix of its own.
    """

    warehouse: str
    year: int = 2024
    month: int = 1
    raw_path: str | None = None
    zone_csv: str | None = None
    mode: str = "month"  # or "replace_all" (reference parity)
    from_layer: str = "raw"  # "clean" resumes from the persisted clean layer
    fail_on_test_error: bool = True
    # Also count the rows left after the cleansing dedup (the reference logs it). Observing
    # there blocks predicate pushdown, so the key-only rules would no longer reach the scan.
    count_duplicates: bool = False
    calendar: tuple[str, str] = (CALENDAR_START, CALENDAR_END)
    landing: str | None = None
    # Leave a month alone that was published from the same files under the same contracts.
    skip_unchanged: bool = False
    file_bytes: int = layout.TARGET_BYTES  # of the fact's files, about
    taxi_type: str = "yellow"
    prefix: str = ""

    def table(self, layer: str, name: str) -> str:
        return table_name(layer, name, self.prefix)

    def source(self) -> str | None:
        if self.raw_path or not self.landing:
            return self.raw_path
        return MonthSource(self.landing, self.year, self.month, self.taxi_type).path

    def path(self, layer: str, name: str) -> str:
        return f"{self.warehouse.rstrip('/')}/data/{layer}/{name}"

    @classmethod
    def from_args(cls, argv: list[str] | None = None) -> MonthJob:
        p = argparse.ArgumentParser(description="Monthly trip job on Spark")
        p.add_argument("--warehouse", required=True)
        p.add_argument("--year", type=int, default=2024)
        p.add_argument("--month", type=int, default=1)
        p.add_argument("--raw-path")
        p.add_argument("--landing", help="folder of month files, instead of --raw-path")
        p.add_argument("--taxi-type", choices=TAXI_TYPES, default="yellow")
        p.add_argument("--zone-csv")
        p.add_argument("--calendar-start", default=CALENDAR_START)
        p.add_argument("--calendar-end", default=CALENDAR_END)
        p.add_argument("--mode", choices=sinks.MODES, default="month")
        p.add_argument("--from-layer", choices=LAYER_ORDER, default="raw")
        p.add_argument("--no-fail-on-test-error", action="store_true")
        p.add_argument("--count-duplicates", action="store_true")
        p.add_argument("--skip-unchanged", action="store_true")
        a = p.parse_args(argv)
        return cls(
            warehouse=a.warehouse,
            year=a.year,
            month=a.month,
            raw_path=a.raw_path,
            zone_csv=a.zone_csv,
            mode=a.mode,
            from_layer=a.from_layer,
            fail_on_test_error=not a.no_fail_on_test_error,
            count_duplicates=a.count_duplicates,
            skip_unchanged=a.skip_unchanged,
            calendar=(a.calendar_start, a.calendar_end),
            landing=a.landing,
            taxi_type=a.taxi_type,
        )


def round2(x: float | None) -> float | None:
    """Spark's round(x, 2) on a double: HALF_UP on the shortest decimal text of x."""
    if x is None:
        return None
    return float(Decimal(repr(float(x))).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


class StaleLayer(RuntimeError):
    """A stored layer does not follow the present contract."""


def contract(schema: StructType) -> str:
    """A short name of a layer's columns and types, kept with what is stored."""
    text = ",".join(f"{f.name} {f.dataType.simpleString()}" for f in schema.fields)
    return hashlib.sha256(text.encode()).hexdigest()[:16]


def unchanged(warehouse: Warehouse, job: MonthJob, source: str | None, zones: str | None) -> bool:
    """Was the month published from these very files, under the present contracts, with its tests run?"""
    tables = warehouse.tables()
    raw, fct = (tables.get(key(*t, job.year, job.month)) for t in (("raw", "trips"), ("marts", "fct_trips")))
    if not raw or not fct or source is None or raw.get("source") != source:
        return False
    if zones is not None and tables.get(key("raw", "zones"), {}).get("source") != zones:
        return False
    models = {n: tables.get(key(layer, n, job.year, job.month)) for layer, n in MODEL_TABLES[:3]}
    fresh = all(e and e.get("contract") == contract(CONTRACTS[n]) for n, e in models.items())
    return fresh and raw.get("contract") == contract(TRIPS_CLEAN) and fct.get("calendar") == list(job.calendar)


def cleanse_and_load(spark: SparkSession, job: MonthJob, run: Run, raw: DataFrame | None = None, source: str | None = None) -> tuple[dict, dict]:
    """Cleanse one month into the run's ``raw.trips``; return (audit, load KPIs).

    The clean count and the load KPIs (revenue, average distance and duration of
    the loaded rows) are observed in the write's result stage, where Spark applies
    each partition's metric update exactly once, also under task retries and lost
    executors; no second pass reads the month back. That observation sits above
    every filter, so the key-only rules still move below the dedup into the
    Parquet scan. The raw count is a plain ``count()`` (a map-stage observation
    could be applied again if that stage were recomputed); on Parquet it reads
    only file metadata. With ``job.count_duplicates`` the rows left by the dedup
    are observed too (the reference logs that number); the observation then
    keeps the rules above the dedup, so it is off by default.
    """
    if raw is None:
        if not job.source():
            raise ValueError("raw_path, landing or a raw DataFrame is required")
        raw = read_landed(spark, job.source())
    deduped = C.dedup_raw(raw)
    o_dedup = None
    if job.count_duplicates:
        o_dedup = Observation("dedup")
        deduped = deduped.observe(o_dedup, F.count(F.lit(1)).alias("rows"))
    o_clean = Observation("clean")
    clean = C.finish(C.rule_filter(C.with_measures(deduped), C.RULE_NAMES, job.year, job.month))
    clean = clean.observe(
        o_clean,
        F.count(F.lit(1)).alias("rows"),
        F.sum("total_amount").alias("revenue"),
        F.avg("trip_distance").alias("avg_distance"),
        F.avg("trip_duration_minutes").alias("avg_duration"),
    )
    check_schema(clean, TRIPS_CLEAN, layer="raw.trips")
    initial, _ = together(raw.count, lambda: run.put(clean, "raw", "trips", job.year, job.month, source=source, contract=contract(TRIPS_CLEAN)))
    m = o_clean.get
    load = {
        "trips_loaded": m["rows"],
        "total_revenue": round2(m["revenue"]),
        "avg_distance": round2(m["avg_distance"]),
        "avg_duration": round2(m["avg_duration"]),
    }
    deduplicated = o_dedup.get["rows"] if o_dedup is not None else None
    return C.audit_from_counts(initial, deduplicated, m["rows"]), load


def build_models(spark: SparkSession, job: MonthJob, run: Run) -> tuple[dict[str, DataFrame], int]:
    """Model graph (O-91) for the run month, stored but not published: the frames, and how many trips lie
    outside the calendar (observed while the fact is written).

    stg_trips (a view would re-run the staging dedup shuffle for every reader), int_trips_enriched
    and the fct_trips mart are month tables; dim_zones and dim_date are replaced whole. stg_zones
    (a few hundred rows) is a view. Every frame is held against its contract before it is written.
    """

    def month_table(layer: str, name: str, df: DataFrame, **more) -> DataFrame:
        facts = {"contract": contract(CONTRACTS[name]), "calendar": list(job.calendar)}
        return run.put(check_schema(df, CONTRACTS[name], layer=name), layer, name, job.year, job.month, **facts, **more)  # O-88

    def whole_table(name: str, df: DataFrame) -> DataFrame:
        return run.put(check_schema(df, CONTRACTS[name], layer=name), "marts", name)

    trips = run.read("raw", "trips", job.year, job.month)
    stg_z = M.stg_zones(run.read("raw", "zones"))
    check_schema(stg_z, STG_ZONES, layer="stg_zones")
    # Duplicate zone ids would fan out the LEFT lookups; check the (small) zone table first.
    dup_zones = Q.unique_violations(stg_z, "location_id").count()
    if dup_zones and job.fail_on_test_error:
        raise Q.DataTestFailure(f"unique_stg_zones_location_id={dup_zones}: zone ids repeat, enrichment would fan out")
    stg = month_table("staging", "stg_trips", M.stg_trips(trips))
    enriched = month_table("intermediate", "int_trips_enriched", M.int_trips_enriched(stg, stg_z))
    seen, (first, last) = Observation("fct"), job.calendar
    outside = F.expr(f"pickup_date NOT BETWEEN DATE'{first}' AND DATE'{last}'")
    # the stored intermediate rows have the fact's columns, so their size tells how many files the fact needs
    stored = run.entry("intermediate", "int_trips_enriched", job.year, job.month)["folder"]
    files = layout.files_for(layout.stored_bytes(spark, f"{run.warehouse.root}/{stored}"), job.file_bytes, layout.cores(spark))
    laid = layout.clustered(M.fct_trips(enriched), files, "pickup_date", "pickup_location_id", "pickup_at")
    observed = laid.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(outside, 1)).alias("outside"))
    fct = month_table("marts", "fct_trips", observed, options={"parquet.block.size": layout.ROW_GROUP_BYTES})
    rows = seen.get["rows"]
    _, _, dim_zones, dim_date = together(
        lambda: run.put(P.trip_partials(fct), "marts", PARTIALS, job.year, job.month),
        lambda: K.put_keys(run, fct, "trip_id", "marts", "fct_trips", job.year, job.month, rows),
        lambda: whole_table("dim_zones", M.dim_zones(stg_z)),
        lambda: whole_table("dim_date", M.dim_date(spark, *job.calendar)),
    )
    frames = {"stg_trips": stg, "stg_zones": stg_z, "int_trips_enriched": enriched, "fct_trips": fct, "dim_zones": dim_zones, "dim_date": dim_date}
    return frames, seen.get["outside"]


def nulls_in_footers(spark: SparkSession, job: MonthJob, run: Run) -> dict[str, int]:
    """Failing rows of the not_null rules over the month's stored models, from their footers (O-80)."""
    session = footer_session(spark)

    def of(layer: str, name: str) -> dict[str, int]:
        rules = {r.column: r.rule_id for r in Q.RULES if r.model == name and r.test == "not_null"}
        entry = run.entry(layer, name, job.year, job.month)
        found = null_counts(session, [f"{run.warehouse.root}/{entry['folder']}"], schema_of(entry), list(rules))
        return {rules[r["column_name"]]: r["nulls"] for r in found.collect()}  # one row a rule

    return {k: n for some in together(*(lambda t=t: of(*t) for t in MODEL_TABLES[:3])) for k, n in some.items()}


# Month-partitioned tables of the models (the others are replaced whole). The fact has its partial aggregates
# beside it, a filter of each month's trip ids and the ids that occur twice in the month.
PARTIALS = "fct_trips_partials"
MODEL_TABLES = [("staging", "stg_trips"), ("intermediate", "int_trips_enriched"), ("marts", "fct_trips"), ("marts", PARTIALS), *(("marts", t) for t in K.key_tables("fct_trips"))]
MONTH_TABLES = [("raw", "trips"), *MODEL_TABLES]
CATALOGUE = [("raw", "trips"), ("raw", "zones"), *MODEL_TABLES[:4], ("marts", "dim_zones"), ("marts", "dim_date")]

CONTRACTS = {
    "stg_trips": STG_TRIPS,
    "stg_zones": STG_ZONES,
    "int_trips_enriched": INT_TRIPS_ENRICHED,
    "fct_trips": FCT_TRIPS,
    "dim_zones": DIM_ZONES,
    "dim_date": DIM_DATE,
}


def build_month(
    spark: SparkSession,
    job: MonthJob,
    raw: DataFrame | None = None,
    zones: DataFrame | None = None,
) -> dict:
    """O-90: run one month end to end. Returns audit, load metrics, the 40 test results and the version.

    Everything is stored first, tested as stored, and published with one commit. With
    ``job.fail_on_test_error`` a failing test raises before the commit, so no layer shows the month.
    """
    tag = f"fareline {job.year:04d}-{job.month:02d}"
    warehouse = Warehouse(spark, job.warehouse)
    for layer, name in CATALOGUE:
        check_location(warehouse, job.table(layer, name))
    run = Run(warehouse)
    # what files the month and the zones come from; frames that the caller gives have no such name
    source = fingerprint(spark, job.source()) if raw is None and job.source() and job.from_layer == "raw" else None
    zone_source = fingerprint(spark, job.zone_csv) if zones is None and job.zone_csv else None
    if job.skip_unchanged and job.from_layer == "raw" and unchanged(warehouse, job, source, zone_source):
        return {"audit": None, "load": None, "tests": [], "version": run.base, "skipped": True}
    audit, load = None, None
    if job.from_layer == "raw":
        with job_description(spark, f"{tag}: cleanse and load"):
            audit, load = cleanse_and_load(spark, job, run, raw, source)
    elif not run.has("raw", "trips", job.year, job.month):
        raise ValueError(f"from_layer='clean' needs {job.year:04d}-{job.month:02d} in {job.path('raw', 'trips')}")
    elif (have := run.entry("raw", "trips", job.year, job.month).get("contract")) != contract(TRIPS_CLEAN):
        raise StaleLayer(f"{key('raw', 'trips', job.year, job.month)} was stored under contract {have}, now {contract(TRIPS_CLEAN)}; run it from raw")
    if zones is None:
        zones = read_zones_optional(spark, job.zone_csv)
    zones_loaded, zones_without_id = 0, 0
    if zones is not None:
        check_schema(zones, ZONES_RAW, layer="raw.zones")
        o_zones = Observation("zones")
        counted = zones.observe(o_zones, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("location_id").isNull(), 1)).alias("bad"))
        with job_description(spark, f"{tag}: load zones"):
            run.put(counted, "raw", "zones", source=zone_source)
        zones_loaded, zones_without_id = o_zones.get["rows"], o_zones.get["bad"]
    elif not run.has("raw", "zones"):
        raise ValueError("no zone lookup given and no raw.zones table to keep")
    if load is None:  # resumed run: the KPIs come from the loaded month
        load = R.kpi_load(run.read("raw", "trips", job.year, job.month)).first().asDict()
    load = {"trips_loaded": load["trips_loaded"], "zones_loaded": zones_loaded, "zones_without_id": zones_without_id, **{
        k: load[k] for k in ("total_revenue", "avg_distance", "avg_duration")}}
    with job_description(spark, f"{tag}: build models"):
        frames, load["trips_outside_calendar"] = build_models(spark, job, run)
    with job_description(spark, f"{tag}: data tests"):
        # trips of the first day of the next month belong to two run months; ids must be unique over all
        alone = job.mode == "replace_all"  # there the other months go
        rows, known = together(
            lambda: K.rows_to_test(run, frames["fct_trips"], "trip_id", "marts", "fct_trips", job.year, job.month, alone),
            lambda: nulls_in_footers(spark, job, run),
        )
        tests = [r.asDict() for r in Q.summary(frames, unique_over={"fct_trips": rows}, known=known).collect()]  # 40 rows, one per rule
    if job.fail_on_test_error:
        Q.raise_on(tests)
    if job.mode == "replace_all":
        for layer, name in MONTH_TABLES:
            for y, m in set(warehouse.months(layer, name, run.base)) - {(job.year, job.month)}:
                run.remove(layer, name, y, m)
    version = run.publish(tag)
    show(spark, job, version)
    sinks.create_view(frames["stg_zones"], "stg_zones")
    return {"audit": audit, "load": load, "tests": tests, "version": version, "skipped": False}


def show(spark: SparkSession, job: MonthJob, version: int | None = None) -> None:
    """Bring the session's catalogue up to what a version of the warehouse holds."""
    sinks.create_layer_schemas(spark, location=job.warehouse, prefix=job.prefix)
    warehouse = Warehouse(spark, job.warehouse)
    for layer, name in CATALOGUE:
        register(warehouse, job.table(layer, name), layer, name, version)


def rebuild_warehouse(spark: SparkSession, job: MonthJob) -> list[dict]:
    """O-94: rebuild every model of every month that the stored clean layer holds.

    Each month is switched by its own commit, so nothing is gone before its successor is there; model
    months that the clean layer lost go afterwards, in one commit.
    """
    warehouse = Warehouse(spark, job.warehouse)
    months = warehouse.months("raw", "trips")
    out = [build_month(spark, replace(job, year=y, month=m, from_layer="clean", mode="month")) for y, m in months]
    run = Run(warehouse)
    for layer, name in MODEL_TABLES:
        for y, m in set(warehouse.months(layer, name)) - set(months):
            run.remove(layer, name, y, m)
    if run.changes:
        show(spark, job, run.publish("months that the clean layer lost"))
    return out


def backfill(spark: SparkSession, job: MonthJob, months: list[tuple[int, int]], raw_for=None, zones=None) -> list[dict]:
    """O-16: run consecutive months; ``raw_for(year, month)`` supplies each month's raw frame."""
    out = []
    for y, m in months:
        j = replace(job, year=y, month=m)
        out.append(build_month(spark, j, raw_for(y, m) if raw_for else None, zones))
    return out


def main(argv: list[str] | None = None) -> dict:
    """spark-submit entry: ``python -m fareline.plans.month_job --warehouse ... --raw-path ...``."""
    job = MonthJob.from_args(argv)
    spark = SparkSession.builder.appName(f"fareline-{job.year:04d}-{job.month:02d}").getOrCreate()
    out = build_month(spark, job)
    print({"audit": out["audit"], "load": out["load"], "failed_tests": [t for t in out["tests"] if t["failing_rows"]]})
    return out


if __name__ == "__main__":
    main()
