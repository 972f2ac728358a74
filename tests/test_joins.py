from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brokerflow.operators.joins import hot_key_join, hot_keys, joint_key, lookup_join


def rows(spark, n=3000):
    """A third of the rows has one key, a third none, a third are spread; some keys have no partner."""
    return spark.range(n).select(
        F.col("id"),
        F.expr("CASE id % 3 WHEN 0 THEN 'hot' WHEN 1 THEN NULL ELSE 'k' || (id % 500) END").alias("key"),
    )


def lookup(spark):
    return spark.range(400).select(
        F.expr("CASE id WHEN 0 THEN 'hot' ELSE 'k' || id END").alias("key"),
        F.expr("CASE WHEN id % 7 = 0 THEN NULL ELSE id END").alias("value"),
    )


def as_set(df):
    return sorted(tuple(r) for r in df.select("id", F.coalesce("key", F.lit("~")), F.coalesce("value", F.lit(-1))).collect())


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("target", [1, 3, None])
def test_hot_key_join_equals_the_plain_join(spark, how, target):
    a, b = rows(spark), lookup(spark)
    assert as_set(hot_key_join(a, b, ["key"], ["id"], how, target)) == as_set(a.join(b, "key", how))


@pytest.mark.parametrize("stored", [True, False])
def test_lookup_join_equals_the_plain_join(spark, stored):
    a, b = rows(spark), lookup(spark)
    assert as_set(lookup_join(a, b, ["key"], ["id"], stored=stored)) == as_set(a.join(b, "key", "left"))


def test_lookup_too_large_to_broadcast(spark, no_broadcast):
    a, b = rows(spark), lookup(spark)
    assert as_set(lookup_join(a, b, ["key"], ["id"], "inner")) == as_set(a.join(b, "key", "inner"))


def test_hot_rows_do_not_meet_in_one_partition(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = hot_key_join(rows(spark, 8000), lookup(spark), ["key"], ["id"])
        sizes = joined.groupBy(F.spark_partition_id().alias("p")).count().collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(r["count"] for r in sizes) < 8000 / 3


def test_hot_keys_are_bounded(spark):
    (hot,) = hot_keys(rows(spark), ["key"], 100).collect()
    assert (hot.key, hot["_slots"]) == ("hot", 10)
    assert hot_keys(rows(spark), ["key"], 1).count() <= 3000


def test_many_equally_heavy_keys_are_all_split(spark):
    """More heavy keys than any fixed list would hold: every one of them goes to several slots."""
    heavy = spark.range(60_000).select("id", F.concat(F.lit("k"), F.col("id") % 1500).alias("key"))
    names = spark.range(1500).select(F.concat(F.lit("k"), "id").alias("key"), F.col("id").alias("value"))
    assert hot_keys(heavy, ["key"], 10).where("_slots = 4").count() == 1500
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = hot_key_join(heavy, names, ["key"], ["id"], "inner", 10)
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(sizes) == 60_000 and max(sizes) < 1.5 * sum(sizes) / len(sizes)


def test_joint_key_tells_null_from_blank(spark):
    df = spark.createDataFrame([("a", None), ("a", ""), ("a", "~"), (None, "a")], "x string, y string")
    assert df.select(joint_key("x", "y").alias("k")).distinct().count() == 4


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(keys=st.lists(st.sampled_from(["a", "b", "c", None]), min_size=1, max_size=30), known=st.sets(st.sampled_from(["a", "b"])))
def test_hot_key_join_on_any_input(spark, keys, known):
    a = spark.createDataFrame(list(enumerate(keys)), "id long, key string")
    b = spark.createDataFrame([(k, ord(k)) for k in known], "key string, value long")
    wanted = sorted((i, k or "~", ord(k) if k in known else -1) for i, k in enumerate(keys))
    assert as_set(hot_key_join(a, b, ["key"], ["id"], target=1)) == wanted


def test_rows_are_neither_sorted_nor_counted_by_key(spark, monkeypatch, tmp_path):
    """What is dealt out unsorted can't spill; more parts than shuffle partitions keep the lookup of a task small."""
    monkeypatch.setattr("brokerflow.operators.joins.LOOKUP_BYTES", 500)
    lookup(spark).write.parquet(str(tmp_path / "names"))
    names = spark.read.parquet(str(tmp_path / "names"))
    even = spark.range(3000).select("id", F.concat(F.lit("k"), F.col("id") % 1000).alias("key"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for found, asked in ((rows(spark), False), (even, True)):
            joined = hot_key_join(found, names, ["key"], ["id"], target=None if not asked else 2000)
            assert as_set(joined) == as_set(found.join(names, "key", "left"))
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
            assert joined.rdd.getNumPartitions() > int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
