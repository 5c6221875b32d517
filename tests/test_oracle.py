"""Every registered query against its DuckDB oracle (multiset equality by column name)."""

import pytest

from fareline.oracle import ORACLE_SQL
from fareline.plans.catalog import QUERIES
from tests.oracle_compare import compare, duck

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLE_SQL)


@pytest.fixture(scope="module")
def con_small():
    return duck(SF0001)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle_sf0001(spark, con_small, name):
    r = compare(spark, name, SF0001, con_small)
    assert r["values_match"], r


HEADLINE = ["clean_trips", "fct_trips", "report_top5_boroughs", "report_time_of_day", "report_weekend",
            "dq_summary", "clean_rejects_by_rule", "audit_metrics", "backfill_two_months"]


@pytest.fixture(scope="module")
def con_mid():
    return duck(SF001)


@pytest.mark.parametrize("name", HEADLINE)
def test_query_matches_oracle_sf001(spark, con_mid, name):
    r = compare(spark, name, SF001, con_mid)
    assert r["values_match"], r


def test_entry_smoke(spark):
    import __spark_entry__ as e

    df = e.entry(spark)
    assert df.columns == ["time_of_day_segment", "trip_count", "avg_distance_miles", "avg_fare_usd"]
    assert df.count() == 5
    assert set(QUERIES) <= set(e.oracle_sql()) <= set(e.queries())


FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "localCheckpoint")


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plan_hygiene(spark, name):
    """No cross products, nested-loop joins or Python UDFs in any registered query."""
    from fareline.plans.explain import plan_text

    plan = plan_text(QUERIES[name](spark, SF0001))
    assert not [f for f in FORBIDDEN if f in plan], name
