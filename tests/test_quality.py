"""The 40 data tests, their failing rows and the summary (O-80..O-87)."""

import pytest
from pyspark.sql import functions as F

from fareline.operators import models as M
from fareline.operators import quality as Q
from tests.seed import seed_trips, seed_zones


@pytest.fixture(scope="module")
def seed(spark):
    return M.star_schema(seed_trips(spark), seed_zones(spark), spark)


def test_forty_rules():
    assert len(Q.RULES) == 40
    per_model = {}
    for r in Q.RULES:
        per_model[r.model] = per_model.get(r.model, 0) + 1
    assert per_model == {"stg_trips": 12, "stg_zones": 4, "int_trips_enriched": 7, "fct_trips": 13, "dim_zones": 4}
    assert len({r.rule_id for r in Q.RULES}) == 40


def test_seed_passes_all(spark, seed):
    rows = Q.summary(seed).collect()
    assert len(rows) == 40
    assert all(r["failing_rows"] == 0 and r["status"] == "pass" for r in rows)
    Q.raise_on([r.asDict() for r in rows])


def test_sf001_only_relationship_fails(spark):
    from fareline.operators.cleanse import cleanse
    from fareline.sources.testdata import raw_trips, raw_zones

    d = "/root/testdata/sf0.01"
    m = M.star_schema(cleanse(raw_trips(spark, d)), raw_zones(spark, d), spark)
    failing = {r["rule_id"]: r["failing_rows"] for r in Q.summary(m).collect() if r["failing_rows"]}
    assert failing == {"relationships_fct_trips_pickup_location_id__location_id__dim_zones": 418}
    with pytest.raises(Q.DataTestFailure):
        Q.raise_on([r.asDict() for r in Q.summary(m).collect()])


def test_unique_counts_values_not_rows(spark, seed):
    fct = seed["fct_trips"]
    dup = fct.unionByName(fct.limit(2)).unionByName(fct.limit(1))
    v = Q.unique_violations(dup, "trip_id").collect()
    assert sorted(r["n_records"] for r in v) == [2, 3]
    nulls = fct.withColumn("trip_id", F.lit(None).cast("string"))
    assert Q.unique_violations(nulls, "trip_id").count() == 0  # NULLs are not duplicates


def test_accepted_values_null_passes(spark, seed):
    fct = seed["fct_trips"]
    bad = fct.withColumn(
        "payment_method",
        F.when(F.col("vendor_id") == 1, F.lit("Crypto")).when(F.col("passenger_count") == 1, F.lit(None)).otherwise(F.col("payment_method")),
    )
    v = Q.accepted_values_violations(bad, "payment_method", Q.PAYMENT_VALUES).collect()
    assert [r["value_field"] for r in v] == ["Crypto"] and v[0]["n_records"] == 80


def test_relationship_null_child_passes(spark, seed):
    fct = seed["fct_trips"].withColumn(
        "pickup_location_id",
        F.when(F.col("vendor_id") == 1, F.lit(None).cast("int")).otherwise(F.lit(999)),
    )
    v = Q.relationship_violations(fct, "pickup_location_id", seed["dim_zones"], "location_id")
    assert v.count() == 40 and {r[0] for r in v.collect()} == {999}


def test_singular_rules_on_raw_mapping(spark):
    from fareline.operators import cleanse as C
    from fareline.sources.testdata import raw_trips

    stg = M.stg_trips(C.finish(C.with_measures(raw_trips(spark, "/root/testdata/sf0.01"))))
    v1 = Q.violations(Q.RULES_BY_ID["assert_pickup_before_dropoff"], {"stg_trips": stg})
    v2 = Q.violations(Q.RULES_BY_ID["assert_positive_trip_metrics"], {"stg_trips": stg})
    assert v1.columns == ["trip_id", "pickup_at", "dropoff_at"] and v1.count() == 57
    assert v2.count() == 237


def test_not_null_rules_share_one_pass(spark, seed):
    from fareline.plans.explain import plan_text

    rules = [r for r in Q.RULES if r.model == "fct_trips" and r.test == "not_null"]
    plan = plan_text(Q.summary(seed, rules))
    assert plan.count("Exchange SinglePartition") <= 2  # one global aggregate for all ten rules


def _unique_rows(df):
    return {r["rule_id"]: r["failing_rows"] for r in df.collect()}


@pytest.mark.parametrize("bound", [100_000, 1])  # hash-first with phase 2; exact fallback
def test_summary_unique_hash_first_is_exact(spark, seed, bound):
    fct = seed["fct_trips"]
    dup = fct.unionByName(fct.limit(2)).unionByName(fct.limit(1))  # two values repeated
    nulls = fct.withColumn("trip_id", F.lit(None).cast("string"))
    frames = dict(seed.items()) if isinstance(seed, dict) else seed
    frames = {**frames, "fct_trips": dup, "int_trips_enriched": nulls}
    rules = [r for r in Q.RULES if r.test == "unique"]
    got = _unique_rows(Q.summary(frames, rules, max_broadcast_rows=bound))
    assert got["unique_fct_trips_trip_id"] == 2
    assert got["unique_int_trips_enriched_trip_id"] == 0  # NULLs are not duplicates
    assert got["unique_stg_trips_trip_id"] == 0 and got["unique_dim_zones_location_id"] == 0


def test_summary_unique_without_candidates_skips_second_pass(spark, seed):
    from fareline.plans.explain import plan_text

    rules = [r for r in Q.RULES if r.test == "unique"]
    out = Q.summary(seed, rules)
    # phase 1 ran once, eagerly; with no candidate hashes the result is constant rows
    assert "xxhash64" not in plan_text(out, "extended")
    assert _unique_rows(out) == {r.rule_id: 0 for r in rules}


def test_each_frame_is_read_once_for_its_rules(spark, seed, monkeypatch):
    """dq_summary's frames: one read of the trips for all row rules, one for all unique rules."""
    reads = []
    one, unique = Q._one_read, Q._unique_counts
    monkeypatch.setattr(Q, "_one_read", lambda df, *a: reads.append(id(df)) or one(df, *a))
    monkeypatch.setattr(Q, "_unique_counts", lambda f, *a: reads.extend({id(x) for x in f.values()}) or unique(f, *a))
    frames = M.rule_frames(seed["stg_trips"], seed["stg_zones"])
    assert len(Q.summary(frames).collect()) == 40
    assert reads.count(id(frames["fct_trips"])) == 2 and reads.count(id(frames["dim_zones"])) == 2


def test_repeated_zone_ids_fan_out_in_the_rules(spark, monkeypatch):
    from fareline.plans import catalog

    trips = seed_trips(spark)
    trips = trips.withColumn("tpep_dropoff_datetime", F.expr("CASE WHEN PULocationID = 3 THEN tpep_pickup_datetime ELSE tpep_dropoff_datetime END"))
    raw = seed_zones(spark).where("location_id <> 9")
    raw = raw.unionByName(raw.where("location_id IN (2, 3)"))
    built = M.star_schema(trips, raw, spark)
    want = {r["rule_id"]: r["failing_rows"] for r in Q.summary(built).collect()}
    got = {r["rule_id"]: r["failing_rows"] for r in Q.summary(M.rule_frames(built["stg_trips"], built["stg_zones"])).collect()}
    assert got == want and got["unique_fct_trips_trip_id"] > 0 and got["unique_stg_trips_trip_id"] == 0
    monkeypatch.setattr(catalog, "_clean", lambda s, d, *a: trips)
    monkeypatch.setattr(catalog, "raw_zones", lambda s, d: raw)
    assert catalog.dq_unique_trip_id(spark, "").count() == want["unique_fct_trips_trip_id"]


def test_unique_over_a_wider_frame(spark, seed):
    rules = [Q.RULES_BY_ID["unique_fct_trips_trip_id"]]
    twice = {"fct_trips": seed["fct_trips"].union(seed["fct_trips"].limit(4))}
    assert Q.summary(seed, rules, unique_over=twice).first()["failing_rows"] == 4
    assert Q.summary(seed, rules).first()["failing_rows"] == 0
