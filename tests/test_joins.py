import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pledgeflow.operators.joins import hot_keys, matching, spread_join
from tests.data import bag

KEYS = st.one_of(st.none(), st.integers(0, 4))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(facts=st.lists(st.tuples(KEYS, st.integers(0, 99)), max_size=25), lookup=st.sets(st.integers(0, 6)), least=st.integers(1, 5))
def test_spread_join_is_the_plain_join(spark, how, facts, lookup, least):
    left = spark.createDataFrame(facts, "k bigint, v bigint")
    right = spark.createDataFrame([(k, k * 10) for k in lookup], "k bigint, w bigint")
    hot = hot_keys(left, ["k"], parts=max(1, len(facts) // least))
    got = spread_join(left, right, ["k"], how, hot, ["v"])
    assert bag(got) == bag(left.join(right, "k", how))


def test_hot_key_is_spread_over_several_tasks(spark):
    facts = spark.range(4000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"), F.col("id").alias("v"))
    lookup = spark.range(5000).select(F.col("id").alias("k"), F.lit("x").alias("w"))
    hot = hot_keys(facts, ["k"], parts=20)
    assert bag(hot) == [(7, 14)]
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        spark.conf.set("spark.sql.adaptive.enabled", "false")

        def largest(df):
            return df.groupBy(F.spark_partition_id().alias("p")).count().agg(F.max("count")).first()[0]

        plain = largest(facts.join(lookup, "k"))
        spread = largest(spread_join(facts, lookup, ["k"], "inner", hot, ["v"]))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert plain > 2600 and spread < 2000  # 4 tasks


def test_hot_key_list_is_bounded(spark):
    facts = spark.range(100).select(F.when(F.col("id") < 40, 1).when(F.col("id") < 55, 2).otherwise(F.col("id")).alias("k"))
    assert bag(hot_keys(facts, ["k"], parts=10)) == [(1, 4), (2, 2)]
    for parts in (1, 3, 1000):
        assert hot_keys(facts, ["k"], parts=parts).count() <= parts
    assert hot_keys(facts.limit(0), ["k"]).count() == 0


def test_matching(spark):
    df = spark.range(10)
    batch = spark.createDataFrame([(3,), (3,), (99,)], "id bigint")
    assert bag(matching(df, batch, ["id"])) == [(3,)]
