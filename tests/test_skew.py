import random

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.operators.skew import hot_keys, lookup_join, salted_join, two_stage_agg
from kinfold.plans import catalogue


def customers_and_accounts(spark, keys, hot=1000):
    c = spark.createDataFrame([(k, f"name-{k}") for k in keys], "k string, name string")
    a = [("hot", i) for i in range(hot)] + [(k, 5000 + i) for i, k in enumerate(keys) if k and k != "bare"]
    a += [(None, 9000), ("orphan", 9001)]
    return c, spark.createDataFrame(a, "k string, account int")


@pytest.mark.parametrize("how", ["left", "inner"])
@pytest.mark.parametrize("min_rows", [1, 10, 1_000_000])
def test_salted_join_equals_join(spark, how, min_rows):
    c, a = customers_and_accounts(spark, ["hot", "cold", "bare", None])
    got = salted_join(c, a, "k", 8, how, min_rows=min_rows)
    assert got.columns == c.join(a, "k", how).columns
    assert rows(got) == rows(c.join(a, "k", how))


KEYS = st.lists(st.sampled_from(["hot", "a", "b", "bare", None]), max_size=6)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(KEYS, st.integers(1, 5), st.integers(0, 40))
def test_salted_join_property(spark, keys, n_salts, hot):
    c, a = customers_and_accounts(spark, keys, hot)
    assert rows(salted_join(c, a, "k", n_salts, "left", min_rows=2)) == rows(c.join(a, "k", "left"))


def test_hot_rows_are_spread(spark):
    c, a = customers_and_accounts(spark, ["hot", "cold"])
    joined = salted_join(c, a.hint("merge"), "k", 8, "left", min_rows=100)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        parts = joined.where("k = 'hot'").groupBy(F.spark_partition_id().alias("p")).count()
        sizes = [r["count"] for r in parts.collect()]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(sizes) >= 3 and max(sizes) < 700


def test_hot_keys(spark):
    _, a = customers_and_accounts(spark, ["hot", "cold"])
    assert rows(hot_keys(a, ["k"], min_rows=100)) == [("hot", 1001)]


def test_more_than_a_thousand_hot_keys(spark):
    one = spark.range(1500).select(F.col("id").cast("string").alias("k"), F.col("id").alias("name"))
    many = spark.range(4500).select((F.col("id") % 1500).cast("string").alias("k"), F.col("id").alias("v"))
    assert hot_keys(many, ["k"], min_rows=3).count() == 1500
    assert rows(salted_join(one, many, "k", 4, "left", min_rows=3)) == rows(one.join(many, "k", "left"))
    weights = many.groupBy("k").agg(F.count("*").alias("n"))
    got = lookup_join(many, weights, ["k"], "n", min_rows=3)
    assert rows(got.select("k", "v", "n")) == rows(many.join(weights, "k").select("k", "v", "n"))


@pytest.mark.parametrize("min_rows", [1, 5, 10**6])
def test_lookup_join_equals_join(spark, min_rows):
    r = random.Random(2)
    many = spark.createDataFrame(
        [(r.choice(["a"] * 5 + list("bcdef")), i) for i in range(200)], "k string, v int"
    )
    one = many.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("top")).where("k <> 'f'")
    got = lookup_join(many, one, ["k"], "n", min_rows)
    assert rows(got.select("k", "v", "top")) == rows(many.join(one, "k").select("k", "v", "top"))


def test_two_stage_agg(spark):
    r = random.Random(4)
    df = spark.createDataFrame(
        [(r.choice(["a", "a", "a", "b", None]), r.choice([1, 2, 3, None]), r.randrange(50)) for _ in range(400)],
        "k string, v int, id int",
    )
    got = two_stage_agg(
        df, ["k"], {"total": F.col("v")}, {"n": F.col("v")},
        {"ids": F.col("id"), "values": F.col("v")}, n_salts=4,
    )
    want = df.groupBy("k").agg(
        F.sum("v").alias("total"), F.count("v").alias("n"),
        F.count_distinct("id").alias("ids"), F.count_distinct("v").alias("values"),
    )
    assert rows(got) == rows(want)


def test_two_stage_agg_reads_once(spark):
    df = spark.range(10).selectExpr("id % 2 as k", "id as v")
    out = two_stage_agg(df, ["k"], {"s": F.col("v")}, {"n": F.col("v")}, {"a": F.col("v"), "b": F.col("v") % 2})
    assert plan(out).count("Range (0, 10") == 1


def test_events_are_spread_before_they_become_json(spark):
    """One row group would be one task, however many rows it has."""
    out = catalogue.QUERIES["cdc_envelope_roundtrip"](spark, "/root/testdata/sf0.001")
    assert out.select(F.spark_partition_id()).distinct().count() == 4
