"""Property test: the rule summary against a plain-Python brute force on random frames."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from fareline.operators import quality as Q

PAY = list(Q.PAYMENT_VALUES)

fact_st = st.lists(
    st.tuples(
        st.one_of(st.none(), st.sampled_from(["a", "b", "c", "d", "e"])),  # trip_id
        st.one_of(st.none(), st.integers(0, 6)),  # pickup_location_id
        st.one_of(st.none(), st.sampled_from(PAY + ["Bitcoin", "IOU"])),  # payment_method
    ),
    min_size=1,
    max_size=30,
)
dim_st = st.lists(
    st.tuples(st.one_of(st.none(), st.integers(0, 4)), st.one_of(st.none(), st.sampled_from(["X", "Y"]))),
    min_size=1,
    max_size=8,
)

RULE_IDS = [
    "unique_fct_trips_trip_id",
    "not_null_fct_trips_trip_id",
    "not_null_fct_trips_pickup_location_id",
    "relationships_fct_trips_pickup_location_id__location_id__dim_zones",
    "accepted_values_fct_trips_payment_method",
    "not_null_fct_trips_payment_method",
    "unique_dim_zones_location_id",
    "not_null_dim_zones_location_id",
    "not_null_dim_zones_borough",
]


def brute(fact, dim):
    def dup_values(values):
        vals = [v for v in values if v is not None]
        return len({v for v in vals if vals.count(v) > 1})

    parents = {k for k, _ in dim if k is not None}
    return {
        "unique_fct_trips_trip_id": dup_values([t for t, _, _ in fact]),
        "not_null_fct_trips_trip_id": sum(t is None for t, _, _ in fact),
        "not_null_fct_trips_pickup_location_id": sum(p is None for _, p, _ in fact),
        "relationships_fct_trips_pickup_location_id__location_id__dim_zones": sum(
            p is not None and p not in parents for _, p, _ in fact
        ),
        "accepted_values_fct_trips_payment_method": len({m for _, _, m in fact if m is not None and m not in PAY}),
        "not_null_fct_trips_payment_method": sum(m is None for _, _, m in fact),
        "unique_dim_zones_location_id": dup_values([k for k, _ in dim]),
        "not_null_dim_zones_location_id": sum(k is None for k, _ in dim),
        "not_null_dim_zones_borough": sum(b is None for _, b in dim),
    }


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(fact_st, dim_st, st.sampled_from([100_000, 1]))  # broadcast paths; shuffle / exact fallbacks
def test_summary_matches_brute_force(spark, fact, dim, bound):
    fct = spark.createDataFrame(fact, "trip_id string, pickup_location_id int, payment_method string")
    zones = spark.createDataFrame(dim, "location_id int, borough string").selectExpr(
        "location_id", "borough", "'z' AS zone_name"
    )
    rules = [Q.RULES_BY_ID[r] for r in RULE_IDS]
    frames = {"fct_trips": fct, "dim_zones": zones}
    got = {r["rule_id"]: r["failing_rows"] for r in Q.summary(frames, rules, max_broadcast_rows=bound).collect()}
    assert got == brute(fact, dim)
