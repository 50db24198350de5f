"""What jobs leave on the disks while they run."""

import glob
import os

import pytest
from conftest import plan, rows
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kinfold.operators import consolidate, match
from kinfold.plans import catalogue
from kinfold.schemas import struct_of
from kinfold.sources.scratch import cut_lineage
from kinfold.sources.tables import read_table, upsert_table
from kinfold.streaming import Landing, batch_log, land, read_lines, staged


def shuffle_files(spark):
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = blocks.getAllFiles()
    return {n for n in (files.apply(i).getName() for i in range(files.size())) if n.startswith("shuffle_")}


def grouped(spark):
    return spark.range(0, 1000, 1, 8).groupBy((F.col("id") % 100).alias("k")).agg(F.count("*").alias("n"))


def test_shuffles_go_when_a_step_is_stored(spark, folder):
    spark.sparkContext._jvm.System.gc()
    grouped(spark).collect()  # leaves its own until the driver collects its garbage
    before = shuffle_files(spark)
    stored = cut_lineage(grouped(spark), "step")
    upsert_table(grouped(spark), f"{folder}/t", "k")
    assert not shuffle_files(spark) - before
    assert stored.count() == read_table(spark, f"{folder}/t", "k").count() == 100
    assert all(f.endswith(".zstd.parquet") for f in stored.inputFiles())
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled") == "false"


def test_batches_are_not_kept_while_they_are_written(spark, folder, monkeypatch):
    """Lines of a batch are several times larger in the cache than in their files."""

    def kept(*_):
        raise AssertionError("a batch is kept")

    monkeypatch.setattr(DataFrame, "persist", kept)
    monkeypatch.setattr(DataFrame, "cache", kept)
    event = '{{"event_id":"{}","event_time":"2024-01-0{} 00:00:00","op_type":"INSERT","payload":"{{\\"v\\":{}}}"}}'
    lines = [event.format("a", 9, 1), event.format("a", 9, 1), event.format("b", 9, 2), "broken"]
    to = Landing(*[f"{folder}/{n}" for n in ("staging", "quarantine", "late", "log")])
    for part in (lines, [event.format("b", 9, 2), event.format("c", 1, 3), event.format("d", 9, 4)]):
        spark.createDataFrame([(x,) for x in part], "value string").coalesce(1).write.mode("append").text(f"{folder}/lines")
        land(read_lines(spark, f"{folder}/lines"), struct_of("v bigint"), to, f"{folder}/offsets", "1 day").awaitTermination()
    assert {(r.event_id, r.v) for r in staged(spark, to.staging).collect()} == {("a", 1), ("b", 2), ("d", 4)}
    assert spark.read.parquet(to.quarantine).first().value == "broken"
    assert spark.read.parquet(to.late).first().event_id == "c"
    counts = batch_log(spark, to).orderBy("batch").select("lines", "staged", "repeated", "late", "malformed").collect()
    assert [tuple(r) for r in counts] == [(4, 2, 1, 0, 1), (3, 1, 1, 1, 0)]


def test_change_events_are_stored_compressed(spark, folder):
    lines = spark.range(1000).select(F.concat(F.lit('{"event_id":"'), "id", F.lit('"}')).alias("value"))
    catalogue._write_lines(lines, f"{folder}/lines")
    assert glob.glob(f"{folder}/lines/*.gz") and not glob.glob(f"{folder}/lines/*.txt")
    assert spark.read.text(f"{folder}/lines").count() == 1000


def people(spark, n):
    c = spark.range(n).select(F.concat(F.lit("C"), "id").alias("customer_id"))
    return c.select(
        "customer_id", F.col("customer_id").alias("golden_customer_id"),
        *[F.lit("x").alias(k) for k in ("first_name", "last_name", "email", "phone", "address", "city", "state", "country")],
    )


def sides(spark, customers, each):
    owner = F.concat(F.lit("C"), (F.col("id") % customers).cast("string")).alias("customer_id")
    ids = spark.range(customers * each)
    number = F.md5(F.col("id").cast("string"))
    a = ids.select(owner, number.alias("account_id"), F.lit("t").alias("account_type"), F.rand(1).alias("balance"), F.lit("s").alias("status"))
    l = ids.select(
        owner, number.alias("loan_id"), F.lit("t").alias("loan_type"), F.rand(2).alias("loan_amount"), F.lit(1.0).alias("emi_amount"),
        F.lit("s").alias("loan_status"),
    )
    return a, l


def shuffled(spark, df):
    """Bytes that a DataFrame writes to shuffle files."""
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    before = shuffle_files(spark)
    df.write.format("noop").mode("overwrite").save()
    files = blocks.getAllFiles()
    paths = [files.apply(i).getPath() for i in range(files.size())]
    return sum(os.path.getsize(p) for p in paths if p.endswith(".data") and os.path.basename(p) in shuffle_files(spark) - before)


def test_hot_customers_are_not_repeated_for_every_task(spark):
    """Customers with 40 accounts and 40 loans, all hot: 8 tasks for each side took ten times the room."""
    c, (a, l) = people(spark, 200), sides(spark, 200, 40)
    once = sum(shuffled(spark, df.repartition(4, "customer_id")) for df in (c, a, l))
    flat = consolidate.resolved_rows(c, a, l, min_rows=4)
    assert shuffled(spark, flat) < 3 * once
    assert flat.count() == 200 * 40 * 40


@pytest.mark.parametrize("n_salts,min_rows", [(1, 1), (3, 2), (8, 10**6)])
def test_chunks_make_the_plain_join(spark, monkeypatch, n_salts, min_rows):
    """Several chunks on both sides, equal rows, one side or both missing, and rows that belong to nobody."""
    monkeypatch.setattr(consolidate, "CHUNK", 3)
    c = people(spark, 5)
    a, l = sides(spark, 3, 7)
    a = a.unionByName(a.where("customer_id = 'C1'")).where("customer_id <> 'C2'")
    a = a.unionByName(a.limit(1).withColumn("customer_id", F.lit(None).cast("string")))
    l = l.withColumn("customer_id", F.expr("case customer_id when 'C0' then 'C4' when 'C2' then 'gone' else customer_id end"))
    c = c.unionByName(c.limit(1).withColumn("customer_id", F.lit(None).cast("string")))
    got = consolidate.resolved_rows(c, a, l, n_salts=n_salts, min_rows=min_rows).drop("resolved_at")
    want = c.join(a.withColumnRenamed("status", "account_status"), "customer_id", "left").join(l, "customer_id", "left")
    assert rows(got) == rows(want.select(*got.columns))


def test_flat_rows_are_reduced_before_they_are_sorted(spark):
    flat = consolidate.resolved_rows(people(spark, 2), *sides(spark, 2, 3))
    stored = cut_lineage(flat, "flat")
    steps = plan(consolidate.profile_from_resolved(stored)).splitlines()
    scans = [i for i, step in enumerate(steps) if "Scan parquet" in step]
    assert len(scans) == 3
    for i in scans:  # what stands above the scan reads its rows
        above = [step for step in reversed(steps[:i]) if any(k in step for k in ("HashAggregate", "Sort"))]
        assert "HashAggregate" in above[0]


def namesakes(spark, n=300):
    """Names of two large blocks, and emails that few share."""
    i = F.col("id").cast("string")
    return spark.range(n).select(
        F.concat(F.lit("C"), F.lpad(i, 5, "0")).alias("customer_id"), F.lit("Ann").alias("first_name"),
        F.concat(F.lit("Lee"), F.substring(F.md5((F.col("id") % 200).cast("string")), 1, 4)).alias("last_name"),
        F.concat(F.lit("e"), (F.col("id") % 40).cast("string")).alias("email"), (F.col("id") % 2).cast("string").alias("phone"),
    )


@pytest.mark.parametrize("find", [
    match.match_pairs, match.one_hop, match.transitive,
    lambda c: match.one_hop(c.withColumn("fresh", F.col("phone") == "1"), fresh="fresh"),
])
def test_names_meet_in_portions_of_their_blocks(spark, monkeypatch, find):
    stored = []
    monkeypatch.setattr(match, "cut_lineage", lambda df, name: stored.append(name) or cut_lineage(df, name))
    c = namesakes(spark)
    want = rows(find(c))
    assert stored.count("near-names") == 1
    monkeypatch.setattr(match, "PORTION_ROWS", 5000)
    assert rows(find(c)) == want and want
    assert stored.count("near-names") > 3
