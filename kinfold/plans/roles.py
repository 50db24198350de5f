"""The given tables in the roles of customers, accounts, loans and change events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.operators.latest import latest_per_key
from kinfold.operators.skew import large
from kinfold.schemas import struct_of

# Bounds that suit the amounts of the given tables.
THRESHOLDS = [
    ("Platinum", 3_500_000, 4_000_000),
    ("Gold", 2_500_000, 3_000_000),
    ("Silver", 1_500_000, 2_000_000),
]
ACCOUNT_STATES = {"O": "ACTIVE", "F": "INACTIVE", "P": "BLOCKED"}
LOAN_STATES = {"A": "ACTIVE", "R": "DELINQUENT", "N": "CLOSED"}
OPERATIONS = {"signup": "INSERT", "error": "DELETE"}

EVENT = struct_of("user_id bigint, value double, props string")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def customer_key(number: Column) -> Column:
    return F.concat(F.lit("CUST-"), F.lpad(number.cast("string"), 10, "0"))


def _mapped(column: Column, values: dict[str, str], other: str | None = None) -> Column:
    out = F.lit(other)
    for k, v in values.items():
        out = F.when(column == k, F.lit(v)).otherwise(out)
    return out


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with a shared contact: nation and market segment as email, the whole part of
    the account balance as phone.

    Nations and regions do not grow with the input, so these are broadcast. Left to itself, Spark takes their join to be as
    large as their product, and sends the customers through the driver in their place.
    """
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    nation = nation.join(F.broadcast(region), F.col("n_regionkey") == F.col("r_regionkey"))
    c = table(spark, sf_dir, "customer").join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey"))
    return c.select(
        customer_key(F.col("c_custkey")).alias("customer_id"),
        F.split_part("c_name", F.lit("#"), F.lit(1)).alias("first_name"),
        F.split_part("c_name", F.lit("#"), F.lit(2)).alias("last_name"),
        F.concat(F.col("c_nationkey").cast("string"), F.lit("|"), "c_mktsegment").alias("email"),
        F.floor("c_acctbal").cast("string").alias("phone"),
        F.lit(None).cast("string").alias("address"),
        F.lit(None).cast("string").alias("city"),
        F.col("n_name").alias("state"),
        F.col("r_name").alias("country"),
    )


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("account_id"),
        customer_key(F.col("o_custkey")).alias("customer_id"),
        F.col("o_orderpriority").alias("account_type"),
        F.col("o_totalprice").alias("balance"),
        _mapped(F.col("o_orderstatus"), ACCOUNT_STATES).alias("status"),
        F.col("o_orderdate").alias("event_time"),
    )


def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as versions of loans: the newest per order and line number."""
    lines = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "l_partkey", "l_suppkey",
        "l_extendedprice", "l_quantity", "l_returnflag", "l_linestatus",
    )
    return latest_per_key(
        lines, ["l_orderkey", "l_linenumber"], "l_shipdate", ["l_partkey", "l_suppkey"]
    )


def _loan(lines: DataFrame, orders: DataFrame) -> DataFrame:
    owner = orders.select("o_orderkey", "o_custkey")
    return lines.join(large(owner), F.col("l_orderkey") == F.col("o_orderkey")).select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("loan_id"),
        customer_key(F.col("o_custkey")).alias("customer_id"),
        F.col("l_linestatus").alias("loan_type"),
        F.col("l_extendedprice").alias("loan_amount"),
        _mapped(F.col("l_returnflag"), LOAN_STATES).alias("loan_status"),
        F.col("l_quantity").alias("emi_amount"),
        F.col("l_shipdate").alias("event_time"),
        "l_partkey",
        "l_suppkey",
    )


def loans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest version of each loan; versions are reduced before the owner is looked up."""
    return _loan(latest_lines(spark, sf_dir), table(spark, sf_dir, "orders")).drop(
        "l_partkey", "l_suppkey"
    )


def loan_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All versions of the loans, with the columns that break ties."""
    return _loan(table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as changes of users."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("timestamp").alias("event_time"),
        _mapped(F.col("event_type"), OPERATIONS, "UPDATE").alias("op_type"),
        "user_id",
        "value",
        "props",
    )
