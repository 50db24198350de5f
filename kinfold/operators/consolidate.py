"""From linked customers, accounts and loans to one row per customer."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions import amount_of, exact_amount, money_sum
from kinfold.operators.latest import latest_per_key
from kinfold.operators.skew import HOT_ROWS, large, spread
from kinfold.schemas import METRIC_COLUMNS, PROFILE_COLUMNS

#: Accounts or loans of a customer that travel in one row.
CHUNK = 64

# The account and loan states that are counted, per metric.
ACCOUNT_STATES = {"active_account_count": "ACTIVE"}
LOAN_STATES = {
    "active_loan_count": "ACTIVE",
    "delinquent_loan_count": "DELINQUENT",
    "closed_loan_count": "CLOSED",
}


def _stamp(stamp: Column | None) -> Column:
    return F.current_timestamp() if stamp is None else stamp


def resolved_rows(
    customers: DataFrame,
    accounts: DataFrame,
    loans: DataFrame,
    stamp: Column | None = None,
    n_salts: int = 8,
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Customers with their accounts and loans: one row per customer, account and loan.

    Customers without accounts or loans stay, with NULLs; accounts and loans without a customer
    go. A customer with m accounts and n loans has m x n rows by definition, so the jobs never
    build this table; it is for readers who want the flat form.

    Accounts and loans come to their customer once, in chunks of at most ``CHUNK``, and each chunk of accounts meets
    each chunk of loans. Pairs of chunks are moved on before they become rows: those of a customer with
    ``min_rows`` accounts or loans to up to ``n_salts`` tasks for each side that has so many, all others together. So a row is
    repeated for every ``CHUNK`` rows of the other side, not for every task.
    """
    a = accounts.select(
        "customer_id", "account_id", "account_type", "balance", F.col("status").alias("account_status")
    )
    l = loans.select("customer_id", "loan_id", "loan_type", "loan_amount", "emi_amount", "loan_status")
    pairs = (
        customers.select(*PROFILE_COLUMNS)
        .join(large(_packed(a, "_a", n_salts, min_rows)), "customer_id", "left")
        .join(large(_packed(l, "_l", n_salts, min_rows)), "customer_id", "left")
    )
    dealt = spread(pairs, "customer_id", "_a_part", "_l_part")
    with_accounts = dealt.select(*PROFILE_COLUMNS, F.explode_outer("_a").alias("_a"), "_l")
    flat = with_accounts.select(*PROFILE_COLUMNS, "_a.*", F.explode_outer("_l").alias("_l"))
    flat = flat.select("*", "_l.*")
    return flat.select(
        *PROFILE_COLUMNS, "account_id", "account_type", "balance", "account_status",
        "loan_id", "loan_type", "loan_amount", "emi_amount", "loan_status",
        _stamp(stamp).alias("resolved_at"),
    )


def _packed(facts: DataFrame, name: str, n_salts: int, min_rows: int) -> DataFrame:
    """The rows of each customer in chunks, and the part of its work that a chunk belongs to.

    Rows are numbered in the order of their values, so a task that is repeated makes the same chunks.
    """
    values = [c for c in facts.columns if c != "customer_id"]
    own = Window.partitionBy("customer_id")
    numbered = facts.where("customer_id is not null").select(
        "customer_id", F.struct(*values).alias(name), F.count("*").over(own).alias("_n"),
        F.floor((F.row_number().over(own.orderBy(*values)) - 1) / CHUNK).alias("_chunk"),
    )
    part = F.when(F.col("_n") >= min_rows, F.pmod("_chunk", F.lit(n_salts))).otherwise(0).alias(f"{name}_part")
    return numbered.groupBy("customer_id", "_n", "_chunk").agg(F.collect_list(name).alias(name)).select("customer_id", name, part)


def account_facts(resolved: DataFrame) -> DataFrame:
    """Each (customer, account) of a resolved table once; conflicting copies are decided by value.

    Equal rows go first, by their hashes: the m x n rows would be sorted on the disks otherwise.
    """
    cols = ["customer_id", "account_id", "balance", "account_status"]
    return latest_per_key(
        resolved.select(*cols).distinct(), ["customer_id", "account_id"], "balance", ["account_status"]
    )


def loan_facts(resolved: DataFrame) -> DataFrame:
    """Each (customer, loan) of a resolved table once."""
    cols = ["customer_id", "loan_id", "loan_amount", "loan_status"]
    return latest_per_key(
        resolved.select(*cols).distinct(), ["customer_id", "loan_id"], "loan_amount", ["loan_status"]
    )


def _metrics(
    facts: DataFrame,
    key: str,
    id_column: str,
    amount: str,
    status: str,
    count_as: str,
    total_as: str,
    states: Mapping[str, str],
    scale: int | None,
) -> DataFrame:
    return facts.groupBy(key).agg(
        F.count(id_column).alias(count_as),
        money_sum(F.col(amount), scale).alias(total_as),
        *[F.count_if(F.col(status) == value).alias(name) for name, value in states.items()],
    )


def customer_profile(
    customers: DataFrame,
    accounts: DataFrame,
    loans: DataFrame,
    by: str = "customer_id",
    stamp: Column | None = None,
    account_states: Mapping[str, str] = ACCOUNT_STATES,
    loan_states: Mapping[str, str] = LOAN_STATES,
    money_scale: int | None = None,
) -> DataFrame:
    """One row per customer: profile columns, counts and totals.

    ``customers`` has one row per customer with ``golden_customer_id``; ``accounts`` and ``loans``
    have one row per account (``customer_id, account_id, balance, account_status``) and loan
    (``customer_id, loan_id, loan_amount, loan_status``). Each side is added up on its own before
    it is joined, by customer id only: accounts never meet loans, a missing profile field does no
    harm, and a customer with very many accounts is reduced to one row before the shuffle.

    ``by="golden_customer_id"`` adds up over all customers with the same golden id, under the
    profile of the golden customer.
    """
    if by not in ("customer_id", "golden_customer_id"):
        raise ValueError("by must be 'customer_id' or 'golden_customer_id'")
    a = _metrics(
        accounts, "customer_id", "account_id", "balance", "account_status",
        "account_count", "total_balance", account_states, money_scale,
    )
    l = _metrics(
        loans, "customer_id", "loan_id", "loan_amount", "loan_status",
        "loan_count", "total_loan_amount", loan_states, money_scale,
    )
    profile = customers.select(*PROFILE_COLUMNS)
    if by == "golden_customer_id":
        owner = customers.select("customer_id", "golden_customer_id")
        golden = owner.select(F.col("golden_customer_id").alias("customer_id")).distinct()
        a = _add_up(owner, a, "total_balance", money_scale)
        l = _add_up(owner, l, "total_loan_amount", money_scale)
        profile = profile.join(large(golden), "customer_id", "left_semi")
    out = profile.join(large(a), "customer_id", "left").join(large(l), "customer_id", "left")
    totals = {"total_balance", "total_loan_amount"}
    metrics = [*METRIC_COLUMNS, *[m for m in (*account_states, *loan_states) if m not in METRIC_COLUMNS]]
    return out.select(
        *PROFILE_COLUMNS,
        *[
            F.coalesce(F.col(m), F.lit(0.0) if m in totals else F.lit(0).cast("bigint")).alias(m)
            for m in metrics if m in out.columns
        ],
        _stamp(stamp).alias("updated_at"),
    )


def _add_up(owner: DataFrame, metrics: DataFrame, amount: str, scale: int | None) -> DataFrame:
    sums = [
        (money_sum(F.col(c), scale) if c == amount else F.sum(c)).alias(c)
        for c in metrics.columns if c != "customer_id"
    ]
    return (
        metrics.join(large(owner), "customer_id")
        .groupBy(F.col("golden_customer_id").alias("customer_id"))
        .agg(*sums)
    )


# --- totals that are kept ------------------------------------------------------------------


def fact_totals(
    accounts: DataFrame,
    loans: DataFrame,
    account_states: Mapping[str, str] = ACCOUNT_STATES,
    loan_states: Mapping[str, str] = LOAN_STATES,
    money_scale: int | None = None,
) -> DataFrame:
    """What the facts of each customer add up to, in a form to which changes can be added later.

    Facts are as in ``customer_profile``; with a column ``sign`` of -1 they are taken away. Counts and sums are exact, so
    adding what came and taking away what went gives the same as adding up anew. ``account_odd`` and ``loan_odd`` count the
    amounts that no decimal holds; a customer with one has to be added up from its facts.
    """
    sides = (
        (accounts, "account_id", "balance", "account_status", "account_count", "total_balance", "account_odd", account_states),
        (loans, "loan_id", "loan_amount", "loan_status", "loan_count", "total_loan_amount", "loan_odd", loan_states),
    )
    counts = [c for *_, n, _, odd, states in sides for c in (n, odd, *states)]
    sums = [total for *_, total, _, _ in sides]
    rows = []
    for facts, ident, amount, status, n, total, odd, states in sides:
        less = F.col("sign") < 0 if "sign" in facts.columns else F.lit(False)
        exact = exact_amount(F.col(amount), money_scale)
        values = {n: F.col(ident).isNotNull(), odd: exact.isNull()} | {a: F.col(status) == v for a, v in states.items()}
        values = {a: F.when(F.coalesce(v, F.lit(False)), F.when(less, -1).otherwise(1)).otherwise(0) for a, v in values.items()}
        money = F.coalesce(exact, F.lit(0).cast("decimal(38,18)"))
        rows.append(facts.where("customer_id is not null").select(
            "customer_id",
            *[values.get(c, F.lit(0)).cast("bigint").alias(c) for c in counts],
            *[(F.when(less, -money).otherwise(money) if c == total else F.lit(0)).cast("decimal(38,18)").alias(c) for c in sums],
        ))
    return add_totals(rows[0].unionByName(rows[1]))


def add_totals(totals: DataFrame) -> DataFrame:
    """One row per customer of several."""
    kinds = {c: t for c, t in totals.dtypes if c != "customer_id"}
    return totals.groupBy("customer_id").agg(*[F.sum(c).cast(t).alias(c) for c, t in kinds.items()])


def profile_from_totals(
    customers: DataFrame, totals: DataFrame | None, stamp: Column | None = None,
    account_states: Mapping[str, str] = ACCOUNT_STATES, loan_states: Mapping[str, str] = LOAN_STATES,
    money_scale: int | None = None,
) -> DataFrame:
    """``customer_profile`` by customer, from totals that are kept; zeros where a customer has none."""
    metrics = [*METRIC_COLUMNS, *[m for m in (*account_states, *loan_states) if m not in METRIC_COLUMNS]]
    if totals is not None:
        customers = customers.select(*PROFILE_COLUMNS).join(large(totals), "customer_id", "left")

    def value(name: str) -> Column:
        if name in ("total_balance", "total_loan_amount"):
            return F.coalesce(amount_of(F.col(name), money_scale), F.lit(0.0)) if totals is not None else F.lit(0.0)
        return F.coalesce(F.col(name), F.lit(0).cast("bigint")) if totals is not None else F.lit(0).cast("bigint")

    wanted = [m for m in metrics if m in (*account_states, *loan_states, "account_count", "loan_count", "total_balance", "total_loan_amount")]
    return customers.select(*PROFILE_COLUMNS, *[value(m).alias(m) for m in wanted], _stamp(stamp).alias("updated_at"))


def profile_from_resolved(
    resolved: DataFrame, stamp: Column | None = None, money_scale: int | None = None
) -> DataFrame:
    """The customer profile of a flat resolved table, without over-counting its m x n rows."""
    different = resolved.select(*PROFILE_COLUMNS).distinct()
    least = Window.partitionBy("customer_id").orderBy(*PROFILE_COLUMNS[1:])
    # As an aggregate, the least row would be taken of all m x n rows, sorted.
    profiles = different.withColumn("_rank", F.row_number().over(least)).where("_rank = 1").drop("_rank")
    return customer_profile(
        profiles, account_facts(resolved), loan_facts(resolved), stamp=stamp, money_scale=money_scale
    )


def distinct_profiles(resolved: DataFrame) -> DataFrame:
    """The different profile rows of a resolved table."""
    return resolved.select(*PROFILE_COLUMNS).dropDuplicates()
