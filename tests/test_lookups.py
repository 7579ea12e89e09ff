"""The spread join must give the plain join's rows, hot keys or not."""

import pytest
from pyspark.sql import functions as F

from tillmetrics.operators.lookups import hot_keys, plan_bytes, with_lookups


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")


def facts(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 7 == 0, F.lit(None)).otherwise(
        (F.col("id") % 50).cast("string")
    )
    return spark.range(3000).select(F.col("id").alias("line"), key.alias("k"))


def lookups(spark):
    one = spark.range(60).select(F.col("id").cast("string").alias("k"), (F.col("id") * 2).alias("a"))
    one = one.unionByName(spark.createDataFrame([("hot", 1), ("hot", 2), (None, 3)], "k string, a bigint"))
    two = spark.createDataFrame([("hot", "x"), ("4", "y")], "k string, b string")
    return one, two


@pytest.mark.parametrize("how", ["left", "inner"])
def test_same_rows_as_the_plain_join(spark, rows, no_broadcast, how):
    f, (one, two) = facts(spark), lookups(spark)
    plain = f.join(one, "k", how).join(two, "k", how)
    spread = with_lookups(f, "k", one, two, how=how, spread_by=["line"])
    assert rows(spread, "line", "k", "a", "b") == rows(plain, "line", "k", "a", "b")


def test_no_hot_key_at_all(spark, rows, no_broadcast):
    f, (one, two) = facts(spark).filter("k <> 'hot'"), lookups(spark)
    spread = with_lookups(f, "k", one, two)
    assert rows(spread, "line", "k", "a", "b") == rows(f.join(one, "k", "left").join(two, "k", "left"), "line", "k", "a", "b")


def test_semi_join(spark, rows, no_broadcast):
    f, (one, _) = facts(spark), lookups(spark)
    names = one.select("k").distinct()
    spread = with_lookups(f, "k", names, how="left_semi")
    assert rows(spread, "line", "k") == rows(f.join(names, "k", "left_semi"), "line", "k")


def test_many_hot_keys_are_all_split(spark, rows, no_broadcast):
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        f = spark.range(8000).select(F.col("id").alias("line"), (F.col("id") % 80).cast("string").alias("k"))
        assert hot_keys(f, "k", 200).count() == 80
        one, two = lookups(spark)
        plain = f.join(one, "k", "left").join(two, "k", "left")
        spread = with_lookups(f, "k", one, two, spread_by=["line"])
        assert rows(spread, "line", "k", "a", "b") == rows(plain, "line", "k", "a", "b")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")


def test_no_job_before_an_action(spark, no_broadcast):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lookups", "planning only")
    with_lookups(facts(spark), "k", *lookups(spark), spread_by=["line"]).schema
    assert not tracker.getJobIdsForGroup("lookups")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_hot_key_lands_on_several_tasks(spark, no_broadcast):
    f, (one, _) = facts(spark), lookups(spark)
    assert hot_keys(f, "k", 4).collect() == [("hot", 2)]
    assert hot_keys(f.filter("k <> 'hot'"), "k", 4).collect() == []
    assert hot_keys(f.filter("false"), "k", 4).collect() == []
    plan = with_lookups(f, "k", *lookups(spark), spread_by=["line"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan


def test_only_big_lookups_are_spread(spark):
    f, two = facts(spark), spark.range(5).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("b"))
    big = spark.range(10**7).select(F.col("id").cast("string").alias("k"), F.lit(1).alias("c"))
    assert plan_bytes(two) < 10485760 < plan_bytes(big)
    plan = with_lookups(f, "k", two, spread_by=["line"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" not in plan
    plan = with_lookups(f, "k", two, big, spread_by=["line"])._jdf.queryExecution().optimizedPlan().toString()
    assert "_slice" in plan


def test_two_big_lookups_share_one_shuffle_of_the_facts(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = with_lookups(facts(spark), "k", *lookups(spark), spread_by=["line"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    # one for the facts, one per lookup, and one for the counts of the keys
    assert plan.count("Exchange hashpartitioning(k") == 4
