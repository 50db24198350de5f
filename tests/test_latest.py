import random

from conftest import plan, rows
from pyspark.sql import functions as F

from kinfold.operators.latest import latest_per_key


def test_keeps_the_newest(spark):
    df = spark.createDataFrame(
        [
            ("CUST-1", "2026-03-18 01:00:00", "old@test.com"),
            ("CUST-1", "2026-03-18 02:00:00", "new@test.com"),
            ("CUST-2", "2026-03-18 01:30:00", "cust2@test.com"),
        ],
        "customer_id string, event_time string, email string",
    )
    got = {r.customer_id: r.email for r in latest_per_key(df, "customer_id").collect()}
    assert got == {"CUST-1": "new@test.com", "CUST-2": "cust2@test.com"}


def test_ties_nulls_and_deletes(spark):
    df = spark.createDataFrame(
        [
            ("a", 5, "UPDATE", "x"), ("a", 5, "UPDATE", "y"),
            ("b", None, "INSERT", "old"), ("b", 1, "INSERT", "timed"),
            ("c", None, "INSERT", "alone"),
            ("d", 1, "INSERT", "was"), ("d", 2, "DELETE", "gone"),
            (None, 1, "INSERT", "n1"), (None, 2, "INSERT", "n2"),
        ],
        "k string, event_time int, op_type string, v string",
    )
    for parts in (1, 4):
        got = {r.k: r.v for r in latest_per_key(df.repartition(parts), "k").collect()}
        assert got == {"a": "y", "b": "timed", "c": "alone", "d": "gone", None: "n2"}
    kept = {r.k for r in latest_per_key(df, "k", drop_deletes=True).collect()}
    assert kept == {"a", "b", "c", None}


def test_half_of_the_customers_updated(spark):
    n = spark.range(10_000).select(F.format_string("CUST-%05d", "id").alias("customer_id"), "id")
    first = n.select("customer_id", F.lit("2026-03-01").alias("event_time"), F.lit("city").alias("city"))
    second = n.where("id < 5000").select(
        "customer_id", F.lit("2026-03-02").alias("event_time"), F.lit("city_UPDATED").alias("city")
    )
    out = latest_per_key(first.union(second), "customer_id")
    assert rows(out.groupBy("city").count()) == [("city", 5000), ("city_UPDATED", 5000)]


def test_typos_keep_all_ids(spark):
    rnd = random.Random(3)

    def typo(word):
        i = rnd.randrange(len(word))
        return word[:i] + rnd.choice("abcdefgh") + word[i + 1:]

    data = [
        (f"CUST-{i:04d}", "2026-03-01", typo(f"First{i}"), typo(f"Last{i}"), "1112223333")
        for i in range(1000)
    ]
    df = spark.createDataFrame(
        data, "customer_id string, event_time string, first_name string, last_name string, phone string"
    )
    assert latest_per_key(df, "customer_id").select("customer_id").distinct().count() >= 950


def test_versions_are_reduced_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("event_time"))
    text = plan(latest_per_key(df, "k"))
    assert text.count("WindowGroupLimit") == 2
    assert text.rindex("WindowGroupLimit") > text.index("Exchange")
