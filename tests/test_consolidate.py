import pytest
from conftest import rows
from pyspark.sql import functions as F

from kinfold.operators.consolidate import (
    account_facts, customer_profile, loan_facts, profile_from_resolved, resolved_rows,
)
from kinfold.operators.latest import latest_per_key

RESOLVED = (
    "customer_id string, golden_customer_id string, first_name string, last_name string, "
    "email string, phone string, address string, city string, state string, country string, "
    "account_id string, account_type string, balance double, account_status string, "
    "loan_id string, loan_type string, loan_amount double, emi_amount double, loan_status string"
)
WHO = ("Ola", "Berg", "ola@post.example", "0470", "5 Havnegata", "Bergen", "VE", "NOR")


def person(key, golden=None, who=WHO):
    return (key, golden or key, *who)


A1 = ("a-1", "CURRENT", 840.0, "ACTIVE")
A2 = ("a-2", "DEPOSIT", 260.0, "ACTIVE")
L1 = ("l-1", "BOAT", 3100.0, 155.0, "ACTIVE")
L2 = ("l-2", "TOOLS", 900.0, 45.0, "DELINQUENT")
NO_A, NO_L = (None,) * 4, (None,) * 5


def profile(spark, data):
    out = profile_from_resolved(spark.createDataFrame(data, RESOLVED)).collect()
    assert len(out) == 1
    return out[0]


def metrics(r):
    return (
        r.account_count, r.loan_count, r.total_balance, r.total_loan_amount,
        r.active_account_count, r.active_loan_count, r.delinquent_loan_count, r.closed_loan_count,
    )


def test_counts_and_sums(spark):
    r = profile(spark, [(*person("C", "G"), *A1, *L1), (*person("C", "G"), *A2, *L2)])
    assert (r.customer_id, r.golden_customer_id) == ("C", "G")
    assert metrics(r) == (2, 2, 1100.0, 4000.0, 2, 1, 1, 0)


def test_no_accounts_and_loans(spark):
    assert metrics(profile(spark, [(*person("C"), *NO_A, *NO_L)])) == (0, 0, 0.0, 0.0, 0, 0, 0, 0)


def test_repeated_row(spark):
    r = profile(spark, [(*person("C"), *A1, *L1)] * 2)
    assert metrics(r)[:4] == (1, 1, 840.0, 3100.0)


def test_accounts_times_loans(spark):
    r = profile(spark, [(*person("C"), *a, *l) for a in (A1, A2) for l in (L1, L2)])
    assert metrics(r) == (2, 2, 1100.0, 4000.0, 2, 1, 1, 0)


def test_missing_profile_field_keeps_the_metrics(spark):
    who = (*WHO[:4], None, *WHO[5:])
    r = profile(spark, [(*person("C", who=who), *A1, *L1)])
    assert r.address is None and metrics(r)[:4] == (1, 1, 840.0, 3100.0)


def test_null_amounts_count_as_zero(spark):
    a = ("a-1", "CURRENT", None, "ACTIVE")
    r = profile(spark, [(*person("C"), *a, *L1), (*person("C"), *A2, *L1)])
    assert metrics(r)[:3] == (2, 1, 260.0)


def test_column_order_and_types(spark):
    out = profile_from_resolved(spark.createDataFrame([(*person("C"), *A1, *L1)], RESOLVED))
    assert out.dtypes[10:] == [
        ("account_count", "bigint"), ("loan_count", "bigint"), ("total_balance", "double"),
        ("active_account_count", "bigint"), ("total_loan_amount", "double"),
        ("active_loan_count", "bigint"), ("delinquent_loan_count", "bigint"),
        ("closed_loan_count", "bigint"), ("updated_at", "timestamp"),
    ]


def staging(spark):
    customers = spark.createDataFrame(
        [("e1", "2026-03-18 01:00:00", "INSERT", *person("K1")),
         ("e2", "2026-03-18 01:00:00", "INSERT", *person("K2"))],
        "event_id string, event_time string, op_type string, " + RESOLVED.split(", account_id")[0],
    )
    accounts = spark.createDataFrame(
        [("K1", *A1), ("GONE", "a-9", "CURRENT", 1.0, "ACTIVE")],
        "customer_id string, account_id string, account_type string, balance double, status string",
    )
    loans = spark.createDataFrame(
        [("K1", *L1)],
        "customer_id string, loan_id string, loan_type string, loan_amount double, emi_amount double, loan_status string",
    )
    return latest_per_key(customers, "customer_id"), accounts, loans


def test_resolved_keeps_bare_customers_and_drops_orphans(spark):
    out = resolved_rows(*staging(spark))
    got = {r.customer_id: (r.account_id, r.loan_id) for r in out.collect()}
    assert got == {"K1": ("a-1", "l-1"), "K2": (None, None)}
    assert len(out.columns) == 20


@pytest.mark.parametrize("min_rows", [1, 1_000_000])
def test_resolved_is_the_plain_join(spark, min_rows):
    data = [(*person(c), *a, *l) for c in ("C1", "C2") for a in (A1, A2) for l in (L1, L2)]
    flat = spark.createDataFrame(data, RESOLVED)
    customers = flat.select(*flat.columns[:10]).distinct()
    accounts = flat.select("customer_id", "account_id", "account_type", "balance", F.col("account_status").alias("status")).distinct()
    loans = flat.select("customer_id", *flat.columns[14:]).distinct()
    out = resolved_rows(customers, accounts, loans, n_salts=4, min_rows=min_rows).drop("resolved_at")
    assert rows(out) == rows(flat)


def test_roll_up_by_golden_customer(spark):
    data = [(*person("C1", "C1"), *A1, *L1), (*person("C2", "C1"), *A2, *L2), (*person("C3", "C3"), *NO_A, *NO_L)]
    flat = spark.createDataFrame(data, RESOLVED)
    customers = flat.select(*flat.columns[:10])
    out = customer_profile(customers, account_facts(flat), loan_facts(flat), by="golden_customer_id")
    got = {r.customer_id: metrics(r) for r in out.collect()}
    assert got == {"C1": (2, 2, 1100.0, 4000.0, 2, 1, 1, 0), "C3": (0, 0, 0.0, 0.0, 0, 0, 0, 0)}


def test_sums_do_not_depend_on_order(spark):
    cents = [(("C"), f"A{i}", 0.1, "ACTIVE") for i in range(1000)]
    facts = spark.createDataFrame(cents, "customer_id string, account_id string, balance double, account_status string")
    flat = spark.createDataFrame([(*person("C"), *NO_A, *NO_L)], RESOLVED)
    customers = flat.select(*flat.columns[:10])
    loans = spark.createDataFrame([], "customer_id string, loan_id string, loan_amount double, loan_status string")
    for parts in (1, 7):
        out = customer_profile(customers, facts.repartition(parts), loans, money_scale=2)
        assert out.first().total_balance == 100.0
    plain = customer_profile(customers, facts, loans).first().total_balance
    assert plain == pytest.approx(100.0)


def test_other_states_can_be_counted(spark):
    flat = spark.createDataFrame([(*person("C"), *A1, "L", "HOME", 1.0, 1.0, "OPEN")], RESOLVED)
    out = customer_profile(
        flat.select(*flat.columns[:10]), account_facts(flat), loan_facts(flat),
        loan_states={"active_loan_count": "OPEN", "closed_loan_count": "CLOSED"},
    ).first()
    assert out.active_loan_count == 1


@pytest.mark.parametrize("by", ["customer_id", "golden_customer_id"])
def test_amounts_are_added_as_they_are(spark, by):
    schema = "customer_id string, account_id string, balance double, account_status string"
    flat = spark.createDataFrame([(*person("C"), *NO_A, *NO_L)], RESOLVED)
    customers = flat.select(*flat.columns[:10])
    loans = spark.createDataFrame([], "customer_id string, loan_id string, loan_amount double, loan_status string")

    def total(amounts, **scale):
        facts = spark.createDataFrame([("C", f"a{i}", x, "ACTIVE") for i, x in enumerate(amounts)], schema)
        return customer_profile(customers, facts, loans, by=by, **scale).first().total_balance

    assert total([0.004, 0.004, 1.25]) == pytest.approx(1.258)
    assert total([0.004, 0.004, 1.25], money_scale=2) == 1.25
    assert total([0.004, 0.004, 1.25], money_scale=3) == 1.258
    assert total([float("nan"), 2.0], money_scale=2) == 2.0
    assert total([float("nan"), 2.0]) != total([float("nan"), 2.0])


@pytest.mark.parametrize("accounts,loans", [(4000, 2), (2, 4000)])
def test_a_customer_hot_on_either_side_is_spread(spark, accounts, loans):
    a = spark.range(accounts).selectExpr(
        "'C' as customer_id", "concat('a', id) as account_id", "'x' as account_type", "1.0D as balance", "'ACTIVE' as status")
    l = spark.range(loans).selectExpr(
        "'C' as customer_id", "concat('l', id) as loan_id", "'x' as loan_type", "1.0D as loan_amount", "1.0D as emi_amount",
        "'ACTIVE' as loan_status")
    flat = spark.createDataFrame([(*person("C"), *NO_A, *NO_L)], RESOLVED)
    conf = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "16"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        out = resolved_rows(flat.select(*flat.columns[:10]), a, l, min_rows=100)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert sum(sizes) == accounts * loans and len(sizes) >= 3 and max(sizes) < sum(sizes) / 2
