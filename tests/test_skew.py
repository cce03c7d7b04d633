"""Lookups and sorts with a key on a third of the rows or more."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from revmap.operators import skew
from revmap.plans.queries import QUERIES

HOWS = ["left", "inner", "left_semi", "left_anti"]


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(skew, "HOT_ROWS", 10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture
def no_coalesce(spark):
    """Adaptive execution would put so few rows into one partition."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


@pytest.fixture
def frames(spark):
    """Key 'hot' on half the rows, no key on a quarter, equal rows among them."""
    big = spark.range(4000).selectExpr(
        "CASE WHEN id < 2000 THEN 'hot' WHEN id < 3000 THEN NULL ELSE concat('k', id) END AS k",
        "CASE WHEN id < 1000 THEN 0 ELSE id END AS v",
    )
    side = spark.sql(
        "SELECT 'hot' AS s, 1 AS w UNION ALL SELECT 'hot', 2 UNION ALL SELECT NULL, 3 "
        "UNION ALL SELECT concat('k', id), id FROM range(3500, 5000)"
    )
    return big, side


def _count(df):
    """Rows with their number of copies."""
    return {tuple(r)[:-1]: r["n"] for r in df.groupBy(*df.columns).agg(F.count("*").alias("n")).collect()}


def test_hot_keys_are_few(frames, no_broadcast):
    assert sorted(skew.hot_keys(frames[0], "k"), key=repr) == ["hot", None]


@pytest.mark.parametrize("how", HOWS)
def test_salted_join_equals_plain_join(frames, no_broadcast, how):
    big, side = frames
    got = skew.lookup_join(big, side, "k", "s", how, hot=["hot", None])
    assert "salt" in got._jdf.queryExecution().analyzed().toString()
    assert _count(got) == _count(big.join(side, F.col("k") == F.col("s"), how))


@pytest.mark.parametrize("how", HOWS)
def test_key_hot_on_the_side_only(spark, no_broadcast, how):
    big = spark.sql("SELECT 'crowd' AS k, 1 AS v UNION ALL SELECT 'none', 2 UNION ALL SELECT NULL, 3 UNION ALL SELECT 'one', 4")
    side = spark.range(600).selectExpr("CASE WHEN id < 500 THEN 'crowd' WHEN id = 500 THEN 'one' ELSE concat('s', id) END AS s", "id AS w")
    got = skew.lookup_join(big, side, "k", "s", how, hot_side=["crowd"])
    if how in ("left", "inner"):
        assert "salt" in got._jdf.queryExecution().analyzed().toString()
    assert _count(got) == _count(big.join(side, F.col("k") == F.col("s"), how))


@pytest.mark.parametrize("how", HOWS)
def test_lookup_join_equals_plain_join(frames, how):
    big, side = frames
    assert _count(skew.lookup_join(big, side, "k", "s", how)) == _count(big.join(side, F.col("k") == F.col("s"), how))


def test_range_condition(frames, no_broadcast):
    big, side = frames
    got = skew.lookup_join(big, side, "k", "s", "inner", F.col("v") > F.col("w"), hot=["hot"])
    assert _count(got) == _count(big.join(side, (F.col("k") == F.col("s")) & (F.col("v") > F.col("w")), "inner"))


def test_hot_rows_reach_many_tasks(frames, no_broadcast, no_coalesce):
    big, side = frames
    got = skew.lookup_join(big.repartition(8), side, "k", "s", "left", hot=["hot"]).where("k = 'hot'")
    assert got.select(F.spark_partition_id()).distinct().count() > 4


def test_no_hot_key_is_a_plain_join(spark, no_broadcast):
    big = spark.range(4000).select(F.col("id").alias("k"))
    got = skew.lookup_join(big, spark.range(10).select(F.col("id").alias("s")), "k", "s", "inner")
    assert "salt" not in got._jdf.queryExecution().analyzed().toString()
    assert got.count() == 10


def test_adaptive_execution_splits_a_hot_key(spark, frames, no_broadcast):
    settings = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k", "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        big = spark.range(200_000).selectExpr("IF(id < 100000, 'hot', concat('k', id)) AS k", "id AS v").repartition(8)
        got = skew.lookup_join(big, frames[1], "k", "s", "left")
        got.write.format("noop").mode("overwrite").save()
        rows = got.count()
        got.collect()
        assert rows == 300_000 and "skew=true" in got._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)


@pytest.mark.parametrize("name", ["mapped_view", "mapping_master_view", "unused_mappings", "merged_report", "manual_revenue"])
def test_building_a_plan_starts_no_job(spark, name):
    sc = spark.sparkContext
    sc.setJobGroup(f"plan-{name}", "building")
    try:
        df = QUERIES[name](spark, "/root/testdata/sf0.001")
        assert sc.statusTracker().getJobIdsForGroup(f"plan-{name}") in ([], ())
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert df.count() >= 0


def test_other_joins_are_refused(frames):
    with pytest.raises(ValueError):
        skew.lookup_join(*frames, "k", "s", "full")


def test_sort_splits_a_hot_key(frames, no_coalesce):
    big = frames[0].repartition(8)
    ordered = skew.ordered_by(big, F.asc_nulls_last("k"))
    keys = [r.k for r in ordered.collect()]
    assert keys[:2000] == ["hot"] * 2000 and keys[-1000:] == [None] * 1000
    where = ordered.where("k = 'hot'").select(F.spark_partition_id()).distinct().count()
    assert where > 1


def test_spread_is_repeatable(frames):
    big = frames[0]
    one = big.select("*", skew.spread(big, 8).alias("salt"))
    assert _count(one) == _count(one)
    assert one.agg(F.count_distinct("salt")).first()[0] == 8
