"""Wire formats and table layouts."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "bigint": T.LongType()}


def struct_of(fields: str) -> T.StructType:
    """A schema from ``"name type, name type"``; needs no running session."""
    pairs = [f.split() for f in fields.split(",")]
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# Field names and types of the JSON change events, and the columns of the tables.
ENVELOPE = struct_of("event_id string, event_time string, op_type string, payload string")
CUSTOMER = struct_of(
    "customer_id string, first_name string, last_name string, email string, phone string, "
    "address string, city string, state string, country string, updated_at string"
)
ACCOUNT = struct_of(
    "account_id string, customer_id string, account_type string, balance double, "
    "status string, updated_at string"
)
LOAN = struct_of(
    "loan_id string, customer_id string, loan_type string, loan_amount double, "
    "loan_status string, emi_amount double, updated_at string"
)
MASTER_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "phone",
    "address", "city", "state", "country",
]
PROFILE_COLUMNS = [
    "customer_id", "golden_customer_id", "first_name", "last_name", "email", "phone",
    "address", "city", "state", "country",
]
METRIC_COLUMNS = [
    "account_count", "loan_count", "total_balance", "active_account_count",
    "total_loan_amount", "active_loan_count", "delinquent_loan_count", "closed_loan_count",
]
SEGMENT_COLUMNS = [
    "customer_id", "first_name", "last_name", "email", "phone", "city", "state", "country",
]
SEGMENT_METRICS = [
    "account_count", "loan_count", "total_balance", "total_loan_amount",
    "active_account_count", "active_loan_count", "delinquent_loan_count", "closed_loan_count",
]
EPOCH = "1970-01-01 00:00:00"

ENTITIES = {
    "customers": ("customer_id", CUSTOMER),
    "accounts": ("account_id", ACCOUNT),
    "loans": ("loan_id", LOAN),
}

MASTER = T.StructType([T.StructField(c, T.StringType()) for c in MASTER_COLUMNS])
