"""No table that grows with the input goes through the driver, however much Spark may broadcast."""

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from kinfold.operators import consolidate, match, merge
from kinfold.operators.closure import connected_components
from kinfold.operators.skew import salted_join
from kinfold.plans import roles
from kinfold.sources.tables import read_table, replace_in_table, write_table


@pytest.fixture
def no_broadcast(spark):
    """Every join is small enough to be broadcast, and every broadcast fails."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "1g", "spark.sql.maxBroadcastTableSize": "1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k in conf:
        spark.conf.unset(k)


def customers(spark, n=60):
    i = F.col("id").cast("string")
    return spark.range(n).select(
        F.concat(F.lit("c"), F.lpad(i, 4, "0")).alias("customer_id"), F.lit("Ann").alias("first_name"),
        F.concat(F.lit("Lee "), F.lpad(i, 4, "0")).alias("last_name"), (F.col("id") % 3).cast("string").alias("email"),
        (F.col("id") % 20).cast("string").alias("phone"),
        *[F.lit("x").alias(c) for c in ("address", "city", "state", "country")],
    )


def facts(spark, n=300):
    owner = F.concat(F.lit("c"), F.lpad((F.col("id") % 60).cast("string"), 4, "0")).alias("customer_id")
    ids = spark.range(n)
    a = ids.select(F.col("id").cast("string").alias("account_id"), owner, F.lit("t").alias("account_type"), F.lit(1.0).alias("balance"), F.lit("ACTIVE").alias("status"))
    l = ids.select(
        F.col("id").cast("string").alias("loan_id"), owner, F.lit("t").alias("loan_type"), F.lit(2.0).alias("loan_amount"),
        F.lit(1.0).alias("emi_amount"), F.lit("ACTIVE").alias("loan_status"),
    )
    return a, l


@pytest.mark.parametrize("min_rows", [2, 1000])
def test_matching_broadcasts_nothing(spark, no_broadcast, min_rows):
    c = customers(spark)
    assert match.match_pairs(c, min_rows).count() > 0
    for closure in ("one_hop", "transitive"):
        assert match.assign_golden(c, closure, min_rows).count() == 60


@pytest.mark.parametrize("by", ["customer_id", "golden_customer_id"])
@pytest.mark.parametrize("scale", [None, 2])
def test_profiles_broadcast_nothing(spark, no_broadcast, by, scale):
    c = customers(spark).withColumn("golden_customer_id", F.col("customer_id"))
    a, l = facts(spark)
    out = consolidate.customer_profile(c, a.withColumnRenamed("status", "account_status"), l, by, money_scale=scale)
    assert {(r.account_count, r.total_loan_amount) for r in out.collect()} == {(5, 10.0)}


def test_resolved_rows_broadcast_nothing(spark, no_broadcast):
    c = customers(spark).withColumn("golden_customer_id", F.col("customer_id"))
    flat = consolidate.resolved_rows(c, *facts(spark), min_rows=4)
    assert flat.count() == 60 * 25
    assert consolidate.distinct_profiles(flat).count() == 60
    assert consolidate.profile_from_resolved(flat).count() == 60


def test_joins_of_keys_broadcast_nothing(spark, no_broadcast, folder):
    one, many = spark.range(50).withColumnRenamed("id", "k"), spark.range(200).select((F.col("id") % 50).alias("k"), "id")
    assert salted_join(one, many, "k", min_rows=2).count() == 200
    assert merge.restrict_to(many, one, "k").count() == 200
    assert merge.delete_keys(many, one, "k").count() == 0
    path = f"{folder}/t"
    write_table(many, path, "id")
    replace_in_table(many.where("id < 5"), many.where("id < 10"), path, "id")
    assert read_table(spark, path, "id").count() == 195
    line = spark.range(30).select(F.col("id").alias("u"), (F.col("id") + 1).alias("v"))
    assert {r[0] for r in rows(connected_components(line).select("component"))} == {0}


def test_nations_are_broadcast_and_not_customers(spark):
    """The join of nations and regions is thought to be larger than the customers."""
    c = roles.customers(spark, "/root/testdata/sf0.01")
    assert "BuildLeft" not in plan(c) and plan(c).count("BuildRight") == 2
    assert c.count() == 1500
