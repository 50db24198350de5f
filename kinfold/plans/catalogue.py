"""All queries over the given tables, and for each the SQL that must give the same rows.

Amounts are compared as whole cents, times as timestamps without zone; run stamps are left out.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kinfold.functions import edit_distance, ensure_columns
from kinfold.operators import consolidate, incremental, match, merge, quality, segment, skew
from kinfold.operators.latest import latest_per_key
from kinfold.plans import jobs, roles
from kinfold.schemas import EPOCH, METRIC_COLUMNS, PROFILE_COLUMNS, struct_of
from kinfold.sources.files import (
    parse_cdc, read_master, split_malformed, to_cdc, write_master,
)
from kinfold.sources.scratch import cut_lineage, scratch_path, shuffles_removed
from kinfold.sources.tables import read_table, replace_in_table, upsert_table, write_table
from kinfold.streaming import Landing, batch_log, dedup_stream, ingest, land, read_lines, staged

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under its function name, with the SQL to compare it with."""

    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return register


# The SQL side of the roles.
def _case(column: str, values: dict[str, str], other: str | None = None) -> str:
    whens = " ".join(f"when '{k}' then '{v}'" for k, v in values.items())
    tail = f" else '{other}'" if other else ""
    return f"case {column} {whens}{tail} end"


_KEY = "'CUST-' || lpad(cast({} as varchar), 10, '0')"
_CUSTOMERS = f"""customers as (
  select {_KEY.format('c_custkey')} as customer_id,
         split_part(c_name, '#', 1) as first_name, split_part(c_name, '#', 2) as last_name,
         cast(c_nationkey as varchar) || '|' || c_mktsegment as email,
         cast(cast(floor(c_acctbal) as bigint) as varchar) as phone,
         cast(null as varchar) as address, cast(null as varchar) as city,
         n_name as state, r_name as country
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)"""
_ACCOUNTS = f"""accounts as (
  select cast(o_orderkey as varchar) as account_id, {_KEY.format('o_custkey')} as customer_id,
         o_orderpriority as account_type, o_totalprice as balance,
         {_case('o_orderstatus', roles.ACCOUNT_STATES)} as status, o_orderdate as event_time
  from orders)"""
_LOANS = f"""versions as (
  select cast(l_orderkey as varchar) || '-' || cast(l_linenumber as varchar) as loan_id,
         {_KEY.format('o_custkey')} as customer_id, l_linestatus as loan_type,
         l_extendedprice as loan_amount, {_case('l_returnflag', roles.LOAN_STATES)} as loan_status,
         l_quantity as emi_amount, l_shipdate as event_time, l_partkey, l_suppkey
  from lineitem join orders on l_orderkey = o_orderkey),
loans as (
  select loan_id, customer_id, loan_type, loan_amount, loan_status, emi_amount, event_time
  from (select *, row_number() over (partition by loan_id
               order by event_time desc, l_partkey desc, l_suppkey desc) as rn from versions)
  where rn = 1)"""
_PAIRS = """named as (select customer_id, first_name || ' ' || last_name as name, email, phone from customers),
pairs as (
  select a.customer_id as id_a, b.customer_id as id_b from named a join named b on a.email = b.email
   where a.customer_id < b.customer_id and levenshtein(a.name, b.name) <= 2
  union
  select a.customer_id, b.customer_id from named a join named b on a.phone = b.phone
   where a.customer_id < b.customer_id and levenshtein(a.name, b.name) <= 2)"""
_GOLDEN = """golden as (
  select customer_id, coalesce(least(customer_id, min(id_a)), customer_id) as golden_customer_id
  from customers left join pairs on customer_id = id_b group by customer_id)"""
_MONEY = "coalesce(cast(sum(cast({} as decimal(18,2))) as double), 0.0)"
_METRICS = f"""account_metrics as (
  select {{key}} as k, count(account_id) as account_count, {_MONEY.format('balance')} as total_balance,
         count(*) filter (status = 'ACTIVE') as active_account_count
  from accounts join golden using (customer_id) group by 1),
loan_metrics as (
  select {{key}} as k, count(loan_id) as loan_count, {_MONEY.format('loan_amount')} as total_loan_amount,
         count(*) filter (loan_status = 'ACTIVE') as active_loan_count,
         count(*) filter (loan_status = 'DELINQUENT') as delinquent_loan_count,
         count(*) filter (loan_status = 'CLOSED') as closed_loan_count
  from loans join golden using (customer_id) group by 1)"""
_PROFILE = """profile as (
  select c.customer_id, golden_customer_id, first_name, last_name, email, phone, address, city, state, country,
         cast(coalesce(account_count, 0) as bigint) as account_count,
         cast(coalesce(loan_count, 0) as bigint) as loan_count,
         coalesce(total_balance, 0.0) as total_balance,
         cast(coalesce(active_account_count, 0) as bigint) as active_account_count,
         coalesce(total_loan_amount, 0.0) as total_loan_amount,
         cast(coalesce(active_loan_count, 0) as bigint) as active_loan_count,
         cast(coalesce(delinquent_loan_count, 0) as bigint) as delinquent_loan_count,
         cast(coalesce(closed_loan_count, 0) as bigint) as closed_loan_count
  from customers c join golden g using (customer_id)
  left join account_metrics a on a.k = c.customer_id left join loan_metrics l on l.k = c.customer_id)"""
_SEGMENTS = """segments as (
  select customer_id, first_name, last_name, email, phone, city, state, country,
         cast(account_count as double) as account_count, cast(loan_count as double) as loan_count,
         total_balance, total_loan_amount,
         cast(active_account_count as double) as active_account_count,
         cast(active_loan_count as double) as active_loan_count,
         cast(delinquent_loan_count as double) as delinquent_loan_count,
         cast(closed_loan_count as double) as closed_loan_count,
         case """ + " ".join(
    f"when total_balance >= {b} or total_loan_amount >= {l} then '{s}'" for s, b, l in roles.THRESHOLDS
) + """ else 'Dormant' end as segment
  from profile)"""


def _with(*parts: str, select: str) -> str:
    return "with " + ",\n".join(parts) + "\n" + select


_UP_TO_GOLDEN = [_CUSTOMERS, _PAIRS, _GOLDEN]
_UP_TO_PROFILE = [
    *_UP_TO_GOLDEN, _ACCOUNTS, _LOANS, _METRICS.format(key="customer_id"), _PROFILE,
]
_UP_TO_SEGMENTS = [*_UP_TO_PROFILE, _SEGMENTS]
_EVENTS = f"""changes as (
  select cast(event_id as varchar) as event_id, ts as event_time,
         {_case('event_type', roles.OPERATIONS, 'UPDATE')} as op_type, user_id, value, props
  from events)"""
_PROFILE_OUT = ", ".join([*PROFILE_COLUMNS, *METRIC_COLUMNS])


def _ntz(df: DataFrame, column: str = "event_time") -> DataFrame:
    return df.withColumn(column, F.col(column).cast("timestamp_ntz"))


# --- change events -------------------------------------------------------------------------


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events, spread over the tasks before they become JSON; a file's row groups alone may be few."""
    return skew.spread(roles.events(spark, sf_dir), "event_id")


@query(_with(_EVENTS, select="select event_id, event_time, op_type, user_id, value, props from changes"))
def cdc_envelope_roundtrip(spark, sf_dir):
    return _ntz(parse_cdc(to_cdc(_changes(spark, sf_dir)), roles.EVENT))


@query(
    "select cast(event_id as varchar) as event_id, event_type in ('error') as is_delete, "
    "cast(json_extract(props, '$.k') as bigint) as k from events"
)
def cdc_object_payload(spark, sf_dir):
    """A payload given as a JSON object instead of a text decodes to the same fields."""
    e = _changes(spark, sf_dir)
    inner = F.from_json("props", "k bigint")
    raw = e.select(F.to_json(F.struct("event_id", "op_type", inner.alias("payload"))).alias("value"))
    return parse_cdc(raw, struct_of("k bigint")).select(
        "event_id", (F.col("op_type") == "DELETE").alias("is_delete"), "k"
    )


def _with_broken(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change events, where the lines of errors have lost the end of their JSON."""
    e = _changes(spark, sf_dir)
    return e.select("op_type", *to_cdc_columns(e)).select(
        F.when(F.col("op_type") == "DELETE", F.rtrim(F.lit("}"), "value"))
        .otherwise(F.col("value")).alias("value")
    )


def to_cdc_columns(e: DataFrame):
    inner = F.to_json(F.struct("user_id", "value", "props"))
    return [
        F.to_json(
            F.struct(
                "event_id", F.col("event_time").cast("string").alias("event_time"), "op_type",
                inner.alias("payload"),
            )
        ).alias("value")
    ]


@query(
    _with(
        _EVENTS,
        select="select event_id, event_time, op_type, user_id, value, props from changes where op_type <> 'DELETE'",
    )
)
def cdc_parse_malformed(spark, sf_dir):
    events, _ = split_malformed(_with_broken(spark, sf_dir), roles.EVENT)
    return _ntz(events)


@query("select count(*) as broken_lines from events where event_type = 'error'")
def cdc_quarantine(spark, sf_dir):
    _, broken = split_malformed(_with_broken(spark, sf_dir), roles.EVENT)
    return broken.agg(F.count("value").alias("broken_lines"))


def _event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table read as a stream of JSON change events."""
    schema = roles.table(spark, sf_dir, "events").schema
    rows = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    ident = F.col("event_id").cast("string")
    op = roles._mapped(F.col("event_type"), roles.OPERATIONS, "UPDATE")
    return to_cdc(skew.spread(rows, "event_id"), ["user_id", "value", "props"], ident, "ts", op)


@query(_with(_EVENTS, select="select event_id, event_time, op_type, user_id, value, props from changes"))
def stream_dedup_global(spark, sf_dir):
    """Every event delivered twice, by two streams; staging has each once."""
    twice = _event_stream(spark, sf_dir).unionByName(_event_stream(spark, sf_dir))
    out = scratch_path(spark, "staging")
    ingest(
        twice, roles.EVENT, out, scratch_path(spark, "offsets"), "3650 days"
    ).awaitTermination()
    return _ntz(staged(spark, out).drop("arrived_at", "arrived_on"))


@query(_with(_EVENTS, select="select event_id, event_time, op_type, user_id, value, props from changes"))
def stream_dedup_within_watermark(spark, sf_dir):
    """The same with bounded state: all copies come within the lateness."""
    twice = _event_stream(spark, sf_dir).unionByName(_event_stream(spark, sf_dir))
    out = scratch_path(spark, "staging")
    ingest(
        twice, roles.EVENT, out, scratch_path(spark, "offsets"), "3650 days", "within_watermark",
    ).awaitTermination()
    return _ntz(staged(spark, out).drop("arrived_at", "arrived_on"))


@query(
    _with(
        _EVENTS,
        select="""select event_id, event_time, op_type, user_id, value, props from changes
where op_type <> 'DELETE'
   or event_time > (select max(event_time) from changes where op_type = 'UPDATE') - interval 10 day""",
    )
)
def stream_late_rows(spark, sf_dir):
    """Three sets of files read one after the other: updates, inserts, deletes.

    Spark drops late rows by the bound that the batch before last has set, so the inserts all
    pass, and the deletes that are more than ten days behind the newest update are late.
    """
    e = _changes(spark, sf_dir)
    lines = scratch_path(spark, "lines")
    for op in ("UPDATE", "INSERT", "DELETE"):
        to_cdc(e.where(F.col("op_type") == op)).repartition(4).write.mode("append").text(lines)
    out = scratch_path(spark, "staging")
    ingest(
        read_lines(spark, lines, files_per_trigger=4), roles.EVENT, out,
        scratch_path(spark, "offsets"), "10 days",
    ).awaitTermination()
    return _ntz(staged(spark, out).drop("arrived_at", "arrived_on"))


@query(
    """select count(*) as lines, count(*) filter (event_type <> 'error') as staged,
  count(*) filter (event_type = 'error') as quarantined from events"""
)
def ingest_quarantined(spark, sf_dir):
    """Every line of a topic is staged or put aside, by one reading."""
    lines, to = scratch_path(spark, "lines"), _landing(spark)
    _with_broken(spark, sf_dir).write.text(lines)
    land(read_lines(spark, lines), roles.EVENT, to, scratch_path(spark, "offsets"), "3650 days").awaitTermination()
    counts = [
        spark.read.text(lines).agg(F.count("*").alias("lines")),
        staged(spark, to.staging).agg(F.count("*").alias("staged")),
        spark.read.parquet(to.quarantine).agg(F.count("*").alias("quarantined")),
    ]
    # Three rows of one number each, brought into one row.
    rows = counts[0]
    for c in counts[1:]:
        rows = rows.unionByName(c, allowMissingColumns=True)
    return rows.agg(*[F.max(c).alias(c) for c in ("lines", "staged", "quarantined")])


def _landing(spark: SparkSession) -> Landing:
    return Landing(*[scratch_path(spark, n) for n in ("staging", "quarantine", "late", "batches")])


#: Lines in three deliveries: updates; inserts and copies of some updates; deletes, older copies and broken lines.
_DELIVERIES = f"""
deliveries as (
  select 0 as batch, * from changes where op_type = 'UPDATE'
  union all select 1, * from changes where op_type = 'INSERT' or (op_type = 'UPDATE' and cast(event_id as bigint) % 3 = 0)
  union all select 2, * from changes where op_type = 'DELETE' or cast(event_id as bigint) % 5 = 0),
bounds as (select batch, max(max(event_time)) over (order by batch rows between unbounded preceding and 1 preceding) - interval 10 day as bound
  from deliveries group by batch),
judged as (
  select d.*, coalesce(event_time < bound, false) as is_late from deliveries d join bounds using (batch)),
kept as (select *, row_number() over (partition by event_id order by batch) as nth from judged where not is_late)"""


def _delivered(spark: SparkSession, sf_dir: str) -> Landing:
    e = _changes(spark, sf_dir)
    lines, offsets, to = scratch_path(spark, "lines"), scratch_path(spark, "offsets"), _landing(spark)
    number, update = F.col("event_id").cast("bigint"), F.col("op_type") == "UPDATE"
    parts = [update, (F.col("op_type") == "INSERT") | (update & (number % 3 == 0)), (F.col("op_type") == "DELETE") | (number % 5 == 0)]
    for k, part in enumerate(parts):
        out = to_cdc(e.where(part))
        if k == 2:
            broken = e.where(number % 7 == 0).select(F.concat(F.lit("no event: "), "event_id").alias("value"))
            out = out.unionByName(broken)
        out.write.mode("append").text(lines)
        land(read_lines(spark, lines), roles.EVENT, to, offsets, "10 days").awaitTermination()
    return to


@query(
    _with(
        _EVENTS, _DELIVERIES,
        select="""select batch, lines + case when batch = 2 then broken else 0 end as lines, staged, lines - late - staged as repeated, late,
  case when batch = 2 then broken else 0 end as malformed
from (select batch, count(*) as lines, count(*) filter (is_late) as late from judged group by 1)
join (select batch, count(*) filter (nth = 1) as staged from kept group by 1) using (batch),
  (select count(*) as broken from changes where cast(event_id as bigint) % 7 = 0)""",
    )
)
def ingest_accounted(spark, sf_dir):
    """Every line of three deliveries is staged, repeated, late or malformed."""
    return batch_log(spark, _delivered(spark, sf_dir)).select(F.col("batch").cast("int"), "lines", "staged", "repeated", "late", "malformed")


@query(
    _with(
        _EVENTS, _DELIVERIES,
        select="""select event_id, event_time, op_type, 'staged' as kind from kept where nth = 1
union all select event_id, event_time, op_type, 'late' from judged where is_late""",
    )
)
def ingest_late_kept(spark, sf_dir):
    """The events that are staged, and those that came too late, which are kept beside them."""
    to = _delivered(spark, sf_dir)
    columns = ["event_id", "event_time", "op_type"]
    kinds = ((staged(spark, to.staging), "staged"), (spark.read.parquet(to.late), "late"))
    parts = [_ntz(rows.select(*columns)).withColumn("kind", F.lit(kind)) for rows, kind in kinds]
    return parts[0].unionByName(parts[1])


@query(_with(_CUSTOMERS, select="select * from customers"))
def master_csv_roundtrip(spark, sf_dir):
    """The customer list written as CSV and read back: every field is text."""
    path = scratch_path(spark, "master")
    write_master(roles.customers(spark, sf_dir), path)
    return read_master(spark, path)


# --- newest versions and matching ----------------------------------------------------------


@query(_with(_LOANS, select="select * from loans"))
def latest_loan(spark, sf_dir):
    versions = roles.loan_versions(spark, sf_dir)
    return latest_per_key(versions, "loan_id", "event_time", ["l_partkey", "l_suppkey"]).drop(
        "l_partkey", "l_suppkey"
    )


_LATEST_EVENT = """latest as (select event_id, event_time, op_type, user_id, value, props from
  (select *, row_number() over (partition by user_id order by event_time desc, cast(event_id as bigint) desc) as rn
   from changes) where rn = 1)"""


@query(_with(_EVENTS, _LATEST_EVENT, select="select * from latest"))
def latest_event_per_user(spark, sf_dir):
    e = roles.events(spark, sf_dir)
    return _ntz(latest_per_key(e, "user_id", "event_time", [F.col("event_id").cast("bigint")]))


@query(_with(_EVENTS, _LATEST_EVENT, select="select * from latest where op_type <> 'DELETE'"))
def latest_without_deleted(spark, sf_dir):
    e = roles.events(spark, sf_dir)
    return _ntz(
        latest_per_key(
            e, "user_id", "event_time", [F.col("event_id").cast("bigint")], drop_deletes=True
        )
    )


@query(
    "select p_partkey, coalesce(levenshtein(p_name, lower(p_type)), 9999) as distance, "
    "coalesce(levenshtein(p_name, nullif(p_brand, 'Brand#1')), 9999) as distance_or_null from part"
)
def edit_distances(spark, sf_dir):
    return roles.table(spark, sf_dir, "part").select(
        "p_partkey",
        edit_distance("p_name", F.lower("p_type")).cast("bigint").alias("distance"),
        edit_distance("p_name", F.nullif("p_brand", F.lit("Brand#1"))).cast("bigint")
        .alias("distance_or_null"),
    )


@query(_with(_CUSTOMERS, _PAIRS, select="select id_a, id_b from pairs"))
def match_pairs(spark, sf_dir):
    return match.match_pairs(roles.customers(spark, sf_dir))


@query(
    _with(
        _CUSTOMERS,
        """entries as (
  select 'email' as kind, email as block, first_name || ' ' || last_name as name from customers
  union all select 'phone', phone, first_name || ' ' || last_name from customers)""",
        select="""select kind, block, count(*) as n_customers, count(distinct name) as n_names from entries
where block is not null and name is not null group by kind, block having count(*) >= 2""",
    )
)
def block_sizes(spark, sf_dir):
    return match.block_sizes(roles.customers(spark, sf_dir))


@query(_with(*_UP_TO_GOLDEN, select="select customer_id, golden_customer_id from golden"))
def golden_one_hop(spark, sf_dir):
    golden = match.assign_golden(roles.customers(spark, sf_dir))
    return golden.select("customer_id", "golden_customer_id")


@query(_with(*_UP_TO_GOLDEN, select="select customer_id, golden_customer_id from golden"))
def golden_one_hop_large_blocks(spark, sf_dir):
    """The same with every piece of a name that two names share treated as hot."""
    golden = match.assign_golden(roles.customers(spark, sf_dir), min_rows=2)
    return golden.select("customer_id", "golden_customer_id")


_TRANSITIVE = """edges as (select id_a as a, id_b as b from pairs union select id_b, id_a from pairs),
reach as (
  select customer_id, customer_id as other from customers
  union
  select reach.customer_id, edges.b from reach join edges on reach.other = edges.a)"""


@query(
    _with(
        _CUSTOMERS, _PAIRS, _TRANSITIVE,
        select="select customer_id, min(other) as golden_customer_id from reach group by 1",
    ).replace("with ", "with recursive ", 1)
)
def golden_transitive(spark, sf_dir):
    golden = match.assign_golden(roles.customers(spark, sf_dir), closure="transitive")
    return golden.select("customer_id", "golden_customer_id")


# --- consolidation -------------------------------------------------------------------------


def _golden_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with golden ids, stored once as the jobs do, for they are read several times."""
    return cut_lineage(match.assign_golden(roles.customers(spark, sf_dir)), "golden")


def _account_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return roles.accounts(spark, sf_dir).withColumnRenamed("status", "account_status")


def _profiles(spark: SparkSession, sf_dir: str, by: str = "customer_id") -> DataFrame:
    return consolidate.customer_profile(
        _golden_customers(spark, sf_dir), _account_facts(spark, sf_dir), roles.loans(spark, sf_dir), by=by,
        money_scale=2,
    )


def _segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments of the single customers, which need no matching: each is its own golden one."""
    customers = ensure_columns(
        roles.customers(spark, sf_dir), {"golden_customer_id": F.col("customer_id")}
    )
    profiles = consolidate.customer_profile(
        customers, _account_facts(spark, sf_dir), roles.loans(spark, sf_dir), money_scale=2
    )
    return segment.assign_segment(profiles, roles.THRESHOLDS)


_BARE = """bare_customers as (
  select * from customers union all
  select 'BARE-' || customer_id, first_name, last_name, null, null, address, city, state, country from customers)"""
_RESOLVED_SELECT = """select c.customer_id, golden_customer_id, first_name, last_name, email, phone, address, city,
  state, country, account_id, account_type, balance, a.status as account_status,
  loan_id, loan_type, loan_amount, emi_amount, loan_status
from (select c.*, coalesce(golden_customer_id, c.customer_id) as golden_customer_id
      from bare_customers c left join golden g on c.customer_id = g.customer_id) c
left join accounts a on c.customer_id = a.customer_id
left join loans l on c.customer_id = l.customer_id"""


def _resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All accounts and loans, and beside every customer one more that has neither, and no contact."""
    customers = _golden_customers(spark, sf_dir)
    ident = F.concat(F.lit("BARE-"), F.col("customer_id"))
    none = F.lit(None).cast("string")
    bare = customers.withColumns(
        {"customer_id": ident, "golden_customer_id": ident, "email": none, "phone": none}
    )
    loans = cut_lineage(roles.loans(spark, sf_dir), "loans")
    return consolidate.resolved_rows(
        customers.unionByName(bare), roles.accounts(spark, sf_dir), loans, min_rows=4
    )


@query(_with(*_UP_TO_GOLDEN, _ACCOUNTS, _LOANS, _BARE, select=_RESOLVED_SELECT))
def resolved_rows(spark, sf_dir):
    return _resolved(spark, sf_dir).drop("resolved_at")


@query(_with(*_UP_TO_PROFILE, select=f"select {_PROFILE_OUT} from profile"))
def customer_profile(spark, sf_dir):
    return _profiles(spark, sf_dir).drop("updated_at")


@query(
    _with(
        *_UP_TO_GOLDEN, _ACCOUNTS, _LOANS, _METRICS.format(key="golden_customer_id"), _PROFILE,
        select=f"select {_PROFILE_OUT} from profile where customer_id in (select golden_customer_id from golden)",
    )
)
def customer_profile_by_golden(spark, sf_dir):
    return _profiles(spark, sf_dir, by="golden_customer_id").drop("updated_at")


# Sixteenths of a unit have four decimals, and are added exactly by both sides.
_FINE = "floor({} * 16) / 16"
_FINE_METRICS = (
    _METRICS.replace(_MONEY.format("balance"), f"coalesce(sum({_FINE.format('balance')}), 0.0)")
    .replace(_MONEY.format("loan_amount"), f"coalesce(sum({_FINE.format('loan_amount')}), 0.0)")
)


def _fine_profiles(spark: SparkSession, sf_dir: str, by: str) -> DataFrame:
    accounts = _account_facts(spark, sf_dir).withColumn("balance", F.expr(_FINE.format("balance")))
    loans = roles.loans(spark, sf_dir).withColumn("loan_amount", F.expr(_FINE.format("loan_amount")))
    return consolidate.customer_profile(_golden_customers(spark, sf_dir), accounts, loans, by=by).drop("updated_at")


@query(
    _with(
        *_UP_TO_GOLDEN, _ACCOUNTS, _LOANS, _FINE_METRICS.format(key="customer_id"), _PROFILE,
        select=f"select {_PROFILE_OUT} from profile",
    )
)
def customer_profile_fine_amounts(spark, sf_dir):
    """Amounts with four decimals, added as they are."""
    return _fine_profiles(spark, sf_dir, "customer_id")


@query(
    _with(
        *_UP_TO_GOLDEN, _ACCOUNTS, _LOANS, _FINE_METRICS.format(key="golden_customer_id"), _PROFILE,
        select=f"select {_PROFILE_OUT} from profile where customer_id in (select golden_customer_id from golden)",
    )
)
def customer_profile_by_golden_fine_amounts(spark, sf_dir):
    return _fine_profiles(spark, sf_dir, "golden_customer_id")


@query(
    _with(
        *_UP_TO_PROFILE, _BARE,
        "bare as (select * from bare_customers where customer_id like 'BARE-%')",
        select=f"""select {_PROFILE_OUT} from profile union all
select {_PROFILE_OUT} from (select *, customer_id as golden_customer_id, cast(0 as bigint) as account_count,
  cast(0 as bigint) as loan_count, cast(0 as double) as total_balance, cast(0 as bigint) as active_account_count,
  cast(0 as double) as total_loan_amount, cast(0 as bigint) as active_loan_count,
  cast(0 as bigint) as delinquent_loan_count, cast(0 as bigint) as closed_loan_count from bare)""",
    )
)
def profile_from_resolved(spark, sf_dir):
    """The profile from the stored flat table, where accounts and loans multiply."""
    resolved = cut_lineage(_resolved(spark, sf_dir), "resolved")
    return consolidate.profile_from_resolved(resolved, money_scale=2).drop("updated_at")


@query(
    _with(
        *_UP_TO_GOLDEN, _BARE,
        select=f"""select {', '.join(PROFILE_COLUMNS)} from (select c.*, coalesce(golden_customer_id, c.customer_id)
  as golden_customer_id from bare_customers c left join golden g on c.customer_id = g.customer_id)""",
    )
)
def distinct_profiles(spark, sf_dir):
    return consolidate.distinct_profiles(_resolved(spark, sf_dir))


# --- segments and summaries ----------------------------------------------------------------


@query(_with(*_UP_TO_SEGMENTS, select="select * from segments"))
def segments(spark, sf_dir):
    return _segments(spark, sf_dir)


@query(_with(*_UP_TO_SEGMENTS, select="select segment, count(*) as count from segments group by 1"))
def segment_counts(spark, sf_dir):
    return segment.segment_counts(_segments(spark, sf_dir))


@query(
    _with(
        *_UP_TO_SEGMENTS,
        select="select segment, count(distinct customer_id) as customer_count from segments group by 1",
    )
)
def segment_distribution(spark, sf_dir):
    return segment.segment_distribution(_segments(spark, sf_dir))


@query(
    _with(
        *_UP_TO_SEGMENTS,
        select="""select state, count(distinct customer_id) as customer_count from segments
where state is not null group by 1 order by 2 desc, 1 limit 15""",
    )
)
def top_states(spark, sf_dir):
    return segment.top_states(_segments(spark, sf_dir))


@query(
    _with(
        *_UP_TO_SEGMENTS,
        select=f"""select segment, state, count(*) as customers, {_MONEY.format('total_balance')} as total_balance,
  {_MONEY.format('total_loan_amount')} as total_loan_amount from segments group by 1, 2""",
    )
)
def summary_maintained(spark, sf_dir):
    """Customers and totals by segment and state, kept over a change: what went is taken away, what came is added."""
    after = cut_lineage(_segments(spark, sf_dir), "after")
    # Before, every third customer had half the balance and lived elsewhere, and every fifth was not there.
    number = F.col("customer_id").substr(6, 10).cast("bigint")
    third = number % 3 == 0
    was = after.where(number % 5 != 0).withColumns({
        "state": F.when(third, F.lit("elsewhere")).otherwise(F.col("state")),
        "total_balance": F.when(third, F.round(F.col("total_balance") / 2, 2)).otherwise(F.col("total_balance")),
    })
    came = after.where(third | (number % 5 == 0)).withColumn("sign", F.lit(1))
    went = was.where(third).withColumn("sign", F.lit(-1))
    kept = segment.add_summaries(
        segment.summarise(was, 2).unionByName(segment.summarise(came.unionByName(went), 2))
    )
    return segment.summary_totals(kept, "segment", "state", money_scale=2)


_KPIS = f"""select count(distinct customer_id) as customers, {_MONEY.format('total_balance')} as total_balance,
  {_MONEY.format('total_loan_amount')} as total_loan_amount from segments"""


@query(_with(*_UP_TO_SEGMENTS, select=_KPIS))
def kpis(spark, sf_dir):
    return segment.kpis(_segments(spark, sf_dir), money_scale=2)


@query(_with(*_UP_TO_SEGMENTS, select=_KPIS + " where segment = 'Gold' and state = 'NATION_3'"))
def kpis_filtered(spark, sf_dir):
    return segment.kpis(segment.only(_segments(spark, sf_dir), "Gold", "NATION_3"), money_scale=2)


@query(
    _with(
        *_UP_TO_SEGMENTS,
        select="""select distinct 'segment' as option, segment as value from segments where segment is not null
union all select distinct 'state', state from segments where state is not null""",
    )
)
def filter_options(spark, sf_dir):
    s = _segments(spark, sf_dir)
    segment_options = segment.filter_options(s, "segment").select(
        F.lit("segment").alias("option"), F.col("segment").alias("value")
    )
    state_options = segment.filter_options(s, "state").select(F.lit("state"), "state")
    return segment_options.union(state_options)


@query(
    _with(
        *_UP_TO_SEGMENTS,
        select=f"select {', '.join(segment.SAMPLE_COLUMNS)} from segments order by customer_id limit 100",
    )
)
def segment_sample(spark, sf_dir):
    return segment.segment_sample(_segments(spark, sf_dir))


# --- data quality --------------------------------------------------------------------------


@query(
    _with(
        _CUSTOMERS,
        select="""select count(*) as row_count, count(*) filter (customer_id is null) as customer_id,
  count(*) filter (address is null) as address, count(*) filter (state is null) as state from customers""",
    )
)
def null_counts(spark, sf_dir):
    return quality.null_counts(roles.customers(spark, sf_dir), ["customer_id", "address", "state"])


def _staging_roles(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The roles as staging tables; customers come without an event time."""
    change = {"event_id": F.lit(None).cast("string"), "op_type": F.lit("INSERT")}
    return {
        "customers": roles.customers(spark, sf_dir).withColumns(change),
        "accounts": roles.accounts(spark, sf_dir).withColumns(change),
        "loans": roles.loan_versions(spark, sf_dir).withColumns(change).withColumn(
            "op_type", F.when(F.col("loan_status") != "CLOSED", F.lit("UPDATE"))
        ),
    }


def _report_sql() -> str:
    present = {
        "customers": [c for c in quality.CATALOGUE["customers"].required if c != "event_time"],
        "accounts": quality.CATALOGUE["accounts"].required,
        "loans": quality.CATALOGUE["loans"].required,
    }
    nulls = {"loans.op_type": "(select count(*) from versions where loan_status = 'CLOSED')"}
    rows_of = {"customers": "customers", "accounts": "accounts", "loans": "versions"}
    lines = []
    for name, expected in quality.CATALOGUE.items():
        for c in expected.required:
            there = c in present[name]
            lines.append(
                f"select '{name}' as \"table\", 'column_present' as \"check\", '{c}' as \"column\", "
                f"cast({int(there)} as bigint) as observed, {str(there).lower()} as passed"
            )
        count = f"(select count(*) from {rows_of[name]})"
        lines.append(f"select '{name}', 'min_rows', null, {count}, {count} >= 1")
        for c in expected.not_null:
            if c in present[name]:
                n = nulls.get(f"{name}.{c}", "0")
                lines.append(f"select '{name}', 'not_null', '{c}', {n}, {n} = 0")
    return "\nunion all ".join(lines)


@query(_with(_CUSTOMERS, _ACCOUNTS, _LOANS, select=_report_sql()))
def validation_report(spark, sf_dir):
    return quality.validate(_staging_roles(spark, sf_dir))


@query(
    _with(
        *_UP_TO_SEGMENTS,
        select="select 'min_rows' as \"check\", cast(null as varchar) as \"column\", count(*) as observed, true as passed "
        "from segments union all select 'column_present', c, 1, true from (values "
        + ", ".join(f"('{c}')" for c in quality.SEGMENTS_EXPECTATION.required) + ") v(c)",
    )
)
def segments_check(spark, sf_dir):
    report = quality.check_table(_segments(spark, sf_dir), "segments", quality.SEGMENTS_EXPECTATION)
    return report.drop("table")


# --- incremental work ----------------------------------------------------------------------

_SINCE = "2000-01-01 00:00:00"


@query(_with(_LOANS, select=f"select * from versions where event_time > timestamp '{_SINCE}'"))
def changed_since(spark, sf_dir):
    return incremental.changed_since(roles.loan_versions(spark, sf_dir), "event_time", _SINCE)


@query(
    _with(
        _LOANS,
        select=f"select * from versions where event_time > timestamp '{_SINCE}' - interval 30 day",
    )
)
def changed_since_lookback(spark, sf_dir):
    return incremental.changed_since(
        roles.loan_versions(spark, sf_dir), "event_time", _SINCE, lookback="30 days"
    )


@query(
    _with(
        _CUSTOMERS, _ACCOUNTS, _LOANS,
        select=f"""select customer_id from accounts where event_time > timestamp '{_SINCE}'
union select customer_id from versions where event_time > timestamp '{_SINCE}'
union select customer_id from customers
where timestamp '1992-01-01' + to_days(cast(cast(right(customer_id, 10) as bigint) % 3650 as integer)) > timestamp '{_SINCE}'""",
    )
)
def affected_keys(spark, sf_dir):
    customers = roles.customers(spark, sf_dir).select("customer_id").withColumn(
        "event_time",
        F.timestamp_add("DAY", F.expr("cast(right(customer_id, 10) as bigint) % 3650"), F.lit("1992-01-01").cast("timestamp_ntz")),
    )
    changes = [
        incremental.changed_since(df, "event_time", _SINCE)
        for df in (customers, roles.accounts(spark, sf_dir), roles.loan_versions(spark, sf_dir))
    ]
    return incremental.affected_keys(changes, "customer_id")


@query(
    """select greatest((select max(o_orderdate) from orders), (select max(l_shipdate) from lineitem),
  (select max(ts) from events)) as max_ts"""
)
def max_watermark(spark, sf_dir):
    stamps = [
        roles.table(spark, sf_dir, t).select(F.col(c).alias("event_time"))
        for t, c in (("orders", "o_orderdate"), ("lineitem", "l_shipdate"), ("events", "ts"))
    ]
    return incremental.max_stamp(stamps, "event_time")


def _before_and_after(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a = roles.accounts(spark, sf_dir)
    return a.where(F.col("event_time") <= F.lit(_SINCE).cast("timestamp_ntz")), a


_BEFORE = f"event_time <= timestamp '{_SINCE}'"


@query(
    _with(
        _ACCOUNTS,
        f"touched as (select distinct customer_id from accounts where not ({_BEFORE}) and account_type = '1-URGENT')",
        select=f"""select * from accounts where {_BEFORE} and customer_id not in (select customer_id from touched)
union all select * from accounts where customer_id in (select customer_id from touched)""",
    )
)
def replace_by_keys(spark, sf_dir):
    """Customers with a new urgent account are brought up to date, the others stay as they were."""
    base, now = _before_and_after(spark, sf_dir)
    new = incremental.changed_since(now, "event_time", _SINCE).where("account_type = '1-URGENT'")
    touched = incremental.affected_keys([new], "customer_id")
    return merge.replace_by_keys(
        base, merge.restrict_to(now, touched, "customer_id"), touched, "customer_id"
    )


@query(
    _with(
        _ACCOUNTS,
        f"touched as (select distinct customer_id from accounts where not ({_BEFORE}))",
        select="select * from accounts where customer_id not in (select customer_id from touched)",
    )
)
def delete_keys(spark, sf_dir):
    _, now = _before_and_after(spark, sf_dir)
    new = incremental.changed_since(now, "event_time", _SINCE)
    return merge.delete_keys(now, new, "customer_id")


@query(_with(_LOANS, select="select * from loans"))
def upsert(spark, sf_dir):
    """Newest loans as of a day, updated with the newest of the later versions."""
    versions = roles.loan_versions(spark, sf_dir)
    ties = ["l_partkey", "l_suppkey"]
    day = F.lit(_SINCE).cast("timestamp_ntz")
    base = latest_per_key(versions.where(F.col("event_time") <= day), "loan_id", "event_time", ties)
    later = latest_per_key(
        incremental.changed_since(versions, "event_time", _SINCE), "loan_id", "event_time", ties
    )
    return merge.upsert(base, later, "loan_id").drop(*ties)


@query(
    f"""select user_id, coalesce(max(ts) filter (event_type = 'signup' and value > 20), timestamp '{EPOCH}') as last_seen
from events group by 1"""
)
def insert_if_absent(spark, sf_dir):
    """Every user starts at the epoch unless already known from a large signup."""
    e = roles.table(spark, sf_dir, "events")
    known = (
        e.where("event_type = 'signup' and value > 20").groupBy("user_id").agg(F.max("ts").alias("last_seen"))
    )
    seed = e.select("user_id").distinct().withColumn("last_seen", F.lit(EPOCH).cast("timestamp_ntz"))
    return merge.insert_if_absent(known, seed, "user_id")


@query(
    _with(
        _CUSTOMERS,
        select="select customer_id, customer_id as golden_customer_id, state, true as has_state from customers",
    )
)
def ensure_missing_columns(spark, sf_dir):
    c = roles.customers(spark, sf_dir).select("customer_id", "state")
    return ensure_columns(
        c,
        {
            "golden_customer_id": F.col("customer_id"),
            "state": F.lit("unknown"),
            "has_state": F.col("state").isNotNull(),
        },
    )


@query(
    _with(
        _ACCOUNTS, _LOANS,
        select="""select customer_id, event_time, account_id, cast(null as varchar) as loan_id from accounts
union all select customer_id, event_time, null, loan_id from versions""",
    )
)
def append_new_columns(spark, sf_dir):
    a = roles.accounts(spark, sf_dir).select("customer_id", "event_time", "account_id")
    l = roles.loan_versions(spark, sf_dir).select("customer_id", "event_time", "loan_id")
    return merge.append(a, l)


@query(_with(_LOANS, select="select * from loans"))
def stored_upsert(spark, sf_dir):
    """``upsert`` through a stored table: two runs, the second of changed rows only."""
    versions = roles.loan_versions(spark, sf_dir)
    ties = ["l_partkey", "l_suppkey"]
    day = F.lit(_SINCE).cast("timestamp_ntz")
    path = scratch_path(spark, "loans")
    base = latest_per_key(versions.where(F.col("event_time") <= day), "loan_id", "event_time", ties)
    write_table(base, path, "loan_id")
    later = incremental.changed_since(versions, "event_time", _SINCE)
    upsert_table(latest_per_key(later, "loan_id", "event_time", ties), path, "loan_id")
    return read_table(spark, path, "loan_id").drop(*ties)


@query(
    _with(
        _ACCOUNTS,
        f"touched as (select distinct customer_id from accounts where not ({_BEFORE}) and account_type = '1-URGENT')",
        select=f"""select *, false as refreshed from accounts
where {_BEFORE} and customer_id not in (select customer_id from touched)
union all select *, true from accounts
where customer_id in (select customer_id from touched) and status <> 'BLOCKED'""",
    )
)
def stored_replace(spark, sf_dir):
    """``replace_by_keys`` through a stored table, with a column the first run lacked."""
    base, now = _before_and_after(spark, sf_dir)
    path = scratch_path(spark, "accounts")
    write_table(base, path, "account_id")
    new = incremental.changed_since(now, "event_time", _SINCE).where("account_type = '1-URGENT'")
    touched = incremental.affected_keys([new], "customer_id")
    fresh = merge.restrict_to(now.where("status <> 'BLOCKED'"), touched, "customer_id")
    replace_in_table(
        fresh.withColumn("refreshed", F.lit(True)), merge.restrict_to(now, touched, "customer_id"),
        path, "account_id",
    )
    return read_table(spark, path, "account_id").withColumn("refreshed", F.coalesce("refreshed", F.lit(False)))


def _waves(spark: SparkSession, sf_dir: str) -> dict[str, list[DataFrame]]:
    """The roles as change events in two waves.

    Customers of one market segment first come with another email and name; accounts and loan
    versions come by date.
    """
    c = roles.customers(spark, sf_dir)
    early = c.withColumns(
        {
            "email": F.when(F.col("email").endswith("BUILDING"), F.lit("shared")).otherwise(F.col("email")),
            "last_name": F.when(F.col("email").endswith("BUILDING"), F.reverse("last_name"))
            .otherwise(F.col("last_name")),
        }
    )
    a, l = roles.accounts(spark, sf_dir), roles.loan_versions(spark, sf_dir)
    part, supplier = (F.lpad(F.col(c).cast("string"), 12, "0") for c in ("l_partkey", "l_suppkey"))
    version = F.concat_ws("-", part, supplier, "loan_id", F.to_date("event_time"))
    l = l.withColumn("event_id", version)

    def events(rows, kind, ident, time, wave):
        payload = [c for c in rows.columns if c in [f.name for f in jobs.ENTITIES[kind][1]]]
        return to_cdc(rows, payload, F.concat(F.lit(wave), ident), time, F.lit("INSERT"))

    day = F.lit(_SINCE).cast("timestamp_ntz")
    out = {"customers": [], "accounts": [], "loans": []}
    for wave, customers, when, start in (
        ("1-", early, F.col("event_time") <= day, "1990-01-01 00:00:00"),
        ("2-", c.where(F.col("email").endswith("BUILDING")), F.col("event_time") > day, "2000-01-02 00:00:00"),
    ):
        out["customers"].append(
            events(customers, "customers", F.col("customer_id"), F.lit(start), wave)
        )
        out["accounts"].append(events(a.where(when), "accounts", F.col("account_id"), "event_time", ""))
        out["loans"].append(events(l.where(when), "loans", F.col("event_id"), "event_time", ""))
    return out


def _write_lines(lines: DataFrame, path: str) -> None:
    """Change events as compressed text: as plain text they are many times larger than the tables they are made of."""
    with shuffles_removed(lines.sparkSession):
        lines.write.mode("append").option("compression", "gzip").text(path)


def _refreshed(spark: SparkSession, sf_dir: str, closure: str = "one_hop", together: bool = False) -> jobs.Settings:
    """Ingest both waves and run all jobs after each; with ``together``, each runs on one run of every table."""
    s = jobs.Settings(
        scratch_path(spark, "bank"), lateness="36500 days", money_scale=2,
        closure=closure, thresholds=tuple(roles.THRESHOLDS),
    )
    waves = _waves(spark, sf_dir)
    for wave in (0, 1):
        for entity, parts in waves.items():
            lines = f"{s.base}/lines/{entity}"
            _write_lines(parts[wave], lines)
            jobs.ingest(read_lines(spark, lines), entity, s).awaitTermination()
        jobs.run_all(spark, s)
        if together:
            s = jobs.bring_together(spark, s)
    return s


@query(_with(*_UP_TO_SEGMENTS, select="select * from segments"))
def incremental_segments_brought_together(spark, sf_dir):
    """Segments after two runs of all jobs, with all tables brought together after each."""
    return jobs.segment_table(spark, _refreshed(spark, sf_dir, together=True))


@query(_with(*_UP_TO_PROFILE, select=f"select {_PROFILE_OUT} from profile"))
def incremental_profiles(spark, sf_dir):
    """Profiles after two runs of all jobs, from change events to tables."""
    s = _refreshed(spark, sf_dir)
    return jobs.profile_table(spark, s).drop("updated_at")


@query(
    _with(
        _CUSTOMERS, _PAIRS, _TRANSITIVE,
        "golden as (select customer_id, min(other) as golden_customer_id from reach group by 1)",
        _ACCOUNTS, _LOANS, _METRICS.format(key="customer_id"), _PROFILE, _SEGMENTS,
        select="select s.*, golden_customer_id from segments s join golden using (customer_id)",
    ).replace("with ", "with recursive ", 1)
)
def incremental_segments_transitive(spark, sf_dir):
    """Segments and transitive golden ids after two runs of all jobs."""
    s = _refreshed(spark, sf_dir, "transitive")
    golden = jobs.profile_table(spark, s).select("customer_id", "golden_customer_id")
    return jobs.segment_table(spark, s).join(skew.large(golden), "customer_id")


@query(_with(*_UP_TO_PROFILE, select=f"select {_PROFILE_OUT} from profile"))
def incremental_lagging_topic(spark, sf_dir):
    """Profiles after a run that saw no accounts yet; these are older than what it saw."""
    s = jobs.Settings(
        scratch_path(spark, "bank"), lateness="36500 days", money_scale=2, thresholds=tuple(roles.THRESHOLDS)
    )
    waves = _waves(spark, sf_dir)
    for topics in (("customers", "loans"), ("accounts",)):
        for entity in topics:
            for part in waves[entity]:
                lines = f"{s.base}/lines/{entity}"
                _write_lines(part, lines)
                jobs.ingest(read_lines(spark, lines), entity, s).awaitTermination()
        jobs.resolve(spark, s)
        jobs.consolidate(spark, s)
    return jobs.profile_table(spark, s).drop("updated_at")


# --- skew ----------------------------------------------------------------------------------


@query(
    _with(
        _CUSTOMERS, _ACCOUNTS, _BARE,
        select="""select c.customer_id, state, account_id, balance from bare_customers c
left join accounts a on c.customer_id = a.customer_id""",
    )
)
def salted_join(spark, sf_dir):
    """Customers with three or more accounts are treated as hot; as many others have none."""
    a = roles.accounts(spark, sf_dir).select("customer_id", "account_id", "balance")
    c = roles.customers(spark, sf_dir).select("customer_id", "state")
    bare = c.withColumn("customer_id", F.concat(F.lit("BARE-"), F.col("customer_id")))
    return skew.salted_join(c.unionByName(bare), a, "customer_id", min_rows=3)


@query(
    _with(
        _ACCOUNTS,
        select=f"""select status, account_type, count(account_id) as accounts, count(distinct customer_id) as customers,
  {_MONEY.format('balance')} as total_balance from accounts group by 1, 2""",
    )
)
def two_stage_agg(spark, sf_dir):
    """Fifteen groups that hold all accounts."""
    a = roles.accounts(spark, sf_dir)
    cents = F.round(F.col("balance") * 100.0).cast("bigint")
    out = skew.two_stage_agg(
        a, ["status", "account_type"],
        sums={"cents": cents},
        counts={"accounts": F.col("account_id")},
        distinct={"customers": F.col("customer_id")},
    )
    return out.withColumn("total_balance", F.col("cents") / 100.0).drop("cents")


@query(
    _with(
        _ACCOUNTS,
        select="""select customer_id, count(*) as n_rows from accounts group by 1
having count(*) >= 15""",
    )
)
def hot_keys(spark, sf_dir):
    return skew.hot_keys(roles.accounts(spark, sf_dir), ["customer_id"], min_rows=15)
