"""Key filters and uniqueness over stored months (O-81)."""

import random

import pytest
from pyspark.sql import functions as F

from fareline.operators import keyfilter as K
from fareline.plans.explain import plan_text
from fareline.sinks.snapshots import Run, Warehouse


def test_filter_lets_every_key_through_and_few_others(spark):
    keys = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    filters = K.build_filter(keys.unionByName(keys.limit(5)).union(spark.sql("SELECT CAST(NULL AS STRING)")), "k", 20_000)
    filters = filters.withColumn("name", F.lit("x")).cache()
    shape = filters.agg(F.count("*"), F.max("blocks"), F.min(F.size("words")), F.max(F.size("words"))).first()
    assert tuple(shape) == (8, 8, K.WORDS, K.WORDS)
    assert K.may_hold(keys, "k", filters).where("name = 'x'").count() == 20_000
    others = spark.range(100_000, 200_000).select(F.md5(F.col("id").cast("string")).alias("k"))
    assert K.may_hold(others, "k", filters).count() < 300  # 0.05 % expected
    none = K.build_filter(keys.limit(0), "k", 0)
    assert none.count() == 1 and K.may_hold(keys, "k", none).count() == 0
    assert K.may_hold(keys, "k", none.limit(0)).count() == 0
    filters.unpersist()


@pytest.mark.parametrize("small", [True, False])
def test_a_repeat_five_months_apart_is_found(spark, tmp_path, monkeypatch, small):
    if not small:
        monkeypatch.setattr(K, "BROADCAST_BYTES", 0)
    rng = random.Random(5)
    months = {m: [f"k{m}-{i}" for i in range(300 * m)] for m in range(1, 7)}
    months[6].append("k1-7")  # five months apart
    months[3] += ["k2-1", "k2-2", "k3-9", "k3-9", None, None]
    months[5].append("k2-1")
    run = Run(Warehouse(spark, str(tmp_path / "wh")))
    for m, keys in months.items():
        rng.shuffle(keys)
        df = run.put(spark.createDataFrame([(k, m) for k in keys], "k string, v int"), "marts", "f", 2024, m)
        K.put_keys(run, df, "k", "marts", "f", 2024, m)
    run.publish()
    got = {r["unique_field"]: r["n_records"] for r in K.unique_over_months(run.warehouse, "marts", "f", "k").collect()}
    assert got == {"k1-7": 2, "k2-1": 3, "k2-2": 2, "k3-9": 3}


def test_a_new_month_reads_only_months_whose_filter_hits(spark, tmp_path):
    wh = Warehouse(spark, str(tmp_path / "wh"))
    run = Run(wh)
    for m in range(1, 6):
        df = run.put(spark.range(m * 1000, m * 1000 + 500).select(F.col("id").cast("string").alias("k")), "marts", "f", 2024, m)
        K.put_keys(run, df, "k", "marts", "f", 2024, m)
    run.publish()
    run = Run(wh)
    new = spark.range(9000, 9400).union(spark.sql("SELECT explode(array(1007L, 9001L))")).select(F.col("id").cast("string").alias("k"))
    new = run.put(new, "marts", "f", 2024, 6)
    K.put_keys(run, new, "k", "marts", "f", 2024, 6)
    rows = K.rows_to_test(run, new, "k", "marts", "f", 2024, 6)
    assert sorted(r[0] for r in rows.collect()) == ["1007", "1007", "9001", "9001"]
    plan = plan_text(rows)
    assert "month=1" in plan.replace("%3D", "=") and "month=4" not in plan.replace("%3D", "=")
    alone = K.rows_to_test(run, new, "k", "marts", "f", 2024, 6, alone=True)
    assert sorted(r[0] for r in alone.collect()) == ["9001", "9001"]
