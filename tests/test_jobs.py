import json
import os
import random
from datetime import datetime, timedelta, timezone

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.operators import consolidate, match
from kinfold.operators.latest import latest_per_key
from kinfold.operators.quality import QualityError
from kinfold.operators.segment import assign_segment, customers_by, kpis, summary_by, summary_totals
from kinfold.plans import jobs
from kinfold.schemas import METRIC_COLUMNS, PROFILE_COLUMNS
from kinfold.sources import scratch
from kinfold.sources.tables import replace_in_table, write_table
from kinfold.streaming import read_lines

START = datetime(2026, 1, 1)


class Bank:
    """Random customers, accounts and loans that change from wave to wave."""

    def __init__(self, spark, folder, seed=0, **settings):
        self.spark, self.folder, self.r, self.clock, self.n = spark, folder, random.Random(seed), START, 0
        self.s = jobs.Settings(folder + "/bank", lateness="3650 days", **settings)

    def event(self, entity, payload):
        self.clock += timedelta(seconds=self.r.randint(1, 50))
        self.n += 1
        return entity, {
            "event_id": f"e{self.n:05d}", "event_time": self.clock.isoformat(), "op_type": "INSERT",
            "payload": json.dumps(payload),
        }

    def customer(self, i):
        r = self.r
        return self.event("customers", {
            "customer_id": f"C{i:03d}", "first_name": r.choice(["Jo", "Joa", "Joan", "Joanna", "Max", None]),
            "last_name": r.choice(["Do", "Doe"]), "email": r.choice(["m", "n", f"{i}@x", None]),
            "phone": r.choice(["1", "2", "3", str(i) * 3]), "address": r.choice(["A", None]), "city": "c",
            "state": "TX", "country": "USA",
        })

    def account(self, i, owner):
        return self.event("accounts", {
            "account_id": f"A{i:03d}", "customer_id": f"C{owner:03d}", "account_type": "Savings",
            "balance": self.r.choice([1.5, 30_000.25, 80_000.0, None]),
            "status": self.r.choice(["ACTIVE", "BLOCKED"]),
        })

    def loan(self, i, owner):
        return self.event("loans", {
            "loan_id": f"L{i:03d}", "customer_id": f"C{owner:03d}", "loan_type": "Home",
            "loan_amount": self.r.choice([100.1, 60_000.0, 250_000.0]), "emi_amount": 1.0,
            "loan_status": self.r.choice(["ACTIVE", "DELINQUENT", "CLOSED"]),
        })

    def wave(self, size):
        r = self.r
        out = [self.customer(r.randrange(40)) for _ in range(size)]
        out += [self.account(r.randrange(30), r.randrange(45)) for _ in range(size)]
        out += [self.loan(r.randrange(30), r.randrange(45)) for _ in range(size)]
        return out

    def ingest(self, events):
        for entity in jobs.ENTITIES:
            lines = f"{self.folder}/in/{entity}"
            os.makedirs(lines, exist_ok=True)
            with open(f"{lines}/{self.n}.txt", "w") as f:
                f.write("\n".join(json.dumps(e) for kind, e in events if kind == entity))
            jobs.ingest(read_lines(self.spark, lines), entity, self.s).awaitTermination()

    def full(self):
        """Profiles computed at once from all of staging."""
        latest = {
            e: latest_per_key(jobs.staging(self.spark, e, self.s).drop("arrived_at", "arrived_on"), key)
            for e, (key, _) in jobs.ENTITIES.items()
        }
        golden = match.assign_golden(latest["customers"], self.s.closure)
        accounts = latest["accounts"].withColumnRenamed("status", "account_status")
        return consolidate.customer_profile(golden, accounts, latest["loans"]).drop("updated_at")

    def check(self):
        columns = [*PROFILE_COLUMNS, *METRIC_COLUMNS]
        full = self.full().select(*columns)
        assert rows(jobs.profile_table(self.spark, self.s).select(*columns)) == rows(full)
        names = assign_segment(full).select("customer_id", "segment")
        table = jobs.segment_table(self.spark, self.s)
        assert rows(table.select("customer_id", "segment")) == rows(names)
        kept = jobs.summary(self.spark, self.s)
        for column in ("segment", "state"):
            assert rows(summary_by(kept, column)) == rows(customers_by(table, column))
        got, want = summary_totals(kept).first(), kpis(table).first()
        assert got.customers == want.customers
        assert got.total_balance == pytest.approx(want.total_balance) and got.total_loan_amount == pytest.approx(want.total_loan_amount)


@pytest.mark.parametrize("closure", ["one_hop", "transitive"])
def test_incremental_equals_full(spark, folder, closure):
    bank = Bank(spark, folder, seed=3, closure=closure)
    for size in (30, 6):
        bank.ingest(bank.wave(size))
        outcomes = jobs.run_all(spark, bank.s)
        assert not any(o.skipped for o in outcomes)
        bank.check()
    again = jobs.run_all(spark, bank.s)
    assert all(o.skipped for o in again) and [o.run for o in again] == [2, 2, 2]


def test_tables_brought_together(spark, folder):
    """Later runs, and jobs that were behind, go on from the next generation; the old one can be read as before."""
    bank = Bank(spark, folder, seed=5)
    bank.ingest(bank.wave(20))
    jobs.run_all(spark, bank.s)
    bank.ingest(bank.wave(5))
    jobs.resolve(spark, bank.s)
    old, bank.s = bank.s, jobs.bring_together(spark, bank.s)
    assert bank.s.generation == 1 and bank.s.table("golden") != old.table("golden")
    assert all(os.listdir(bank.s.table(t)) == [f"run={n}"] for t, n in (("resolved", 2), ("profiles", 1), ("golden", 2)))
    assert rows(jobs.profile_table(spark, bank.s)) == rows(jobs.profile_table(spark, old))
    assert not jobs.consolidate(spark, bank.s).skipped and not jobs.segment(spark, bank.s).skipped
    bank.check()
    assert all(o.skipped for o in jobs.run_all(spark, bank.s))
    bank.ingest(bank.wave(4))
    jobs.run_all(spark, bank.s)
    bank.check()


def test_nothing_to_bring_together(spark, folder):
    s = jobs.bring_together(spark, jobs.Settings(folder + "/bank"))
    assert s.generation == 1 and jobs.resolve(spark, s).skipped and jobs.consolidate(spark, s).skipped


def test_a_run_writes_what_changed(spark, folder):
    bank = Bank(spark, folder, seed=9)
    bank.ingest([bank.customer(i) for i in range(300)] + [bank.account(i, i) for i in range(300)] + [bank.loan(1, 1)])
    first = jobs.run_all(spark, bank.s)
    assert first[0].written["customers"] == 300 and first[0].written["accounts"] == 300
    bank.ingest([bank.account(5, 7), bank.account(8, 8)])
    second = jobs.run_all(spark, bank.s)
    # The account moved from 5 to 7; 8 stayed.
    assert second[0].written == {"accounts": 2, "resolved": 3}
    assert second[1].written == {"profiles": 3} and second[2].written == {"segments": 3}
    assert sum(second[2].segments.values()) == 3
    for table in ("resolved", "profiles", "segments"):
        assert spark.read.parquet(f"{bank.s.table(table)}/run=2").count() == 3
    bank.check()


def test_moved_account_and_changed_contact(spark, folder):
    bank = Bank(spark, folder)

    def customer(i, name, email):
        return bank.event("customers", {
            "customer_id": f"C{i}", "first_name": name, "last_name": "X", "email": email, "phone": f"p{i}",
        })

    def account(owner, balance):
        return bank.event("accounts", {
            "account_id": "A", "customer_id": owner, "account_type": "Savings", "balance": balance, "status": "ACTIVE",
        })

    loan = bank.event("loans", {"loan_id": "L", "customer_id": "C1", "loan_type": "Home", "loan_amount": 5.0, "loan_status": "ACTIVE"})
    bank.ingest([customer(1, "Ann", "m"), customer(2, "Anne", "m"), customer(3, "Zoe", "z"), account("C1", 10.0), loan])
    jobs.run_all(spark, bank.s)
    got = {r.customer_id: r for r in jobs.profile_table(spark, bank.s).collect()}
    assert got["C2"].golden_customer_id == "C1" and got["C1"].total_balance == 10.0
    stamps = {k: r.updated_at for k, r in got.items()}

    bank.ingest([customer(1, "Ann", "elsewhere"), account("C2", 20.0)])
    jobs.run_all(spark, bank.s)
    got = {r.customer_id: r for r in jobs.profile_table(spark, bank.s).collect()}
    assert got["C2"].golden_customer_id == "C2"
    assert (got["C1"].account_count, got["C2"].account_count, got["C2"].total_balance) == (0, 1, 20.0)
    assert got["C3"].updated_at == stamps["C3"] and got["C2"].updated_at > stamps["C2"]
    assert got["C1"].loan_count == 1
    bank.check()


def test_a_run_that_dies_is_repeated(spark, folder, monkeypatch):
    bank = Bank(spark, folder, seed=8)
    bank.ingest(bank.wave(25))
    jobs.run_all(spark, bank.s)
    bank.ingest(bank.wave(6))
    for broken in ("replace_in_table", "update_watermark"):
        with monkeypatch.context() as m:
            m.setattr(jobs, broken, lambda *a, **k: (_ for _ in ()).throw(RuntimeError("lost")))
            with pytest.raises(RuntimeError):
                jobs.resolve(spark, bank.s)
    bank.ingest(bank.wave(3))
    jobs.run_all(spark, bank.s)
    bank.check()


def test_resolved_view(spark, folder):
    bank = Bank(spark, folder, seed=5)
    bank.ingest(bank.wave(20))
    jobs.run_all(spark, bank.s)
    view = jobs.resolved_view(spark, bank.s)
    assert len(view.columns) == 20
    again = consolidate.profile_from_resolved(view).select(*PROFILE_COLUMNS, *METRIC_COLUMNS)
    assert rows(again) == rows(jobs.profile_table(spark, bank.s).select(*again.columns))


def test_validation_stops_the_jobs(spark, folder):
    bank = Bank(spark, folder)
    bank.ingest([bank.event("accounts", {"account_id": None, "customer_id": "C"})])
    with pytest.raises(QualityError) as e:
        jobs.run_all(spark, bank.s)
    assert "[accounts] not_null account_id: 1" in str(e.value)
    assert "[customers] min_rows" in str(e.value) and "[loans] min_rows" in str(e.value)
    assert jobs.read_watermark(spark, bank.s.watermarks, "resolve")[1] == 0


def test_watermarks(spark, folder):
    path = folder + "/w"
    epoch = jobs.read_watermark(spark, path, "a")
    assert epoch[0].isoformat() == "1970-01-01T00:00:00+00:00" and epoch[1] == 0
    stamp = datetime.fromisoformat("2026-03-29T01:30:00.123456+00:00")
    jobs.update_watermark(spark, path, "a", stamp, 4)
    jobs.seed_watermarks(spark, path, ["a", "b"])
    assert jobs.read_watermark(spark, path, "a") == (stamp, 4)
    assert jobs.read_watermark(spark, path, "b") == epoch
    assert jobs.read_watermark(spark, path, "c") == epoch
    for d, _, files in os.walk(f"{path}/a"):
        for name in files:
            if name.endswith(".parquet"):
                open(os.path.join(d, name), "wb").close()
    with pytest.raises(Exception):
        jobs.read_watermark(spark, path, "a")
    assert jobs.read_watermark(spark, path, "b") == epoch


def test_nothing_ingested(spark, folder):
    s = jobs.Settings(folder + "/bank")
    assert jobs.resolve(spark, s).skipped and jobs.consolidate(spark, s).skipped
    assert jobs.segment(spark, s).skipped
    with pytest.raises(QualityError, match="segments"):
        jobs.segment_table(spark, s)


def test_late_but_accepted(spark, folder):
    bank = Bank(spark, folder)
    bank.ingest([bank.customer(1), bank.account(1, 1), bank.loan(1, 1)])
    jobs.run_all(spark, bank.s)
    bank.clock -= timedelta(hours=2)
    bank.ingest([bank.customer(2), bank.account(2, 1)])
    jobs.run_all(spark, bank.s)
    bank.check()


@settings(max_examples=2, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.integers(0, 10**6), st.lists(st.sets(st.sampled_from(["customers", "accounts", "loans"]), min_size=1), min_size=1, max_size=2))
def test_topics_may_come_in_any_order(spark, tmp_path_factory, seed, turns):
    bank = Bank(spark, str(tmp_path_factory.mktemp("bank")), seed=seed)
    waiting = bank.wave(12)
    for topics in [*turns, {"customers", "accounts", "loans"}]:
        now = [e for e in waiting if e[0] in topics]
        waiting = [e for e in waiting if e[0] not in topics] + bank.wave(4)
        bank.n += 1
        bank.ingest(now)
        jobs.resolve(spark, bank.s)
        jobs.consolidate(spark, bank.s)
        jobs.segment(spark, bank.s)
    bank.check()


def test_malformed_lines_fail_the_gate(spark, folder):
    bank = Bank(spark, folder, seed=2)
    bank.ingest(bank.wave(5))
    with open(f"{folder}/in/accounts/broken.txt", "w") as f:
        f.write("{not json\n\"neither\"")
    jobs.ingest(read_lines(spark, f"{folder}/in/accounts"), "accounts", bank.s).awaitTermination()
    assert jobs.quarantined(spark, "accounts", bank.s).count() == 2
    assert jobs.staging(spark, "accounts", bank.s).count() == 5
    with pytest.raises(QualityError, match=r"\[accounts\] malformed_lines : 2"):
        jobs.validate(spark, bank.s)


def test_columns_that_stored_profiles_lack(spark, folder):
    bank = Bank(spark, folder, seed=4)
    bank.ingest(bank.wave(10))
    jobs.resolve(spark, bank.s)
    jobs.consolidate(spark, bank.s)
    path = bank.s.table("profiles")
    old = spark.read.parquet(path).drop("run", "closed_loan_count", "city").collect()
    kept = spark.read.parquet(path).drop("run", "closed_loan_count", "city").schema
    spark.createDataFrame(old, kept).write.mode("overwrite").parquet(f"{path}/run=1")
    jobs.segment(spark, bank.s)
    got = jobs.segment_table(spark, bank.s)
    assert got.where("closed_loan_count is null and city is null").count() == got.count() > 0


def test_a_job_leaves_no_intermediate_tables(spark, folder):
    bank = Bank(spark, folder, seed=6)
    bank.ingest(bank.wave(5))
    before = scratch.mark(spark)
    jobs.run_all(spark, bank.s)
    assert scratch.mark(spark) == before


def test_a_cluster_must_name_its_shared_folder():
    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(ValueError):
        scratch.shared_folder(Session())


def jobs_of(spark, group, f):
    spark.sparkContext.setJobGroup(group, group)
    try:
        f()
    finally:
        spark.sparkContext.setJobGroup("", "")
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_a_watermark_takes_few_jobs(spark, folder):
    """There are some 25 of them in a run of all jobs, and each plan leaves something in the driver."""
    for run in (1, 2):
        assert jobs_of(spark, f"{folder}-w{run}", lambda: jobs.update_watermark(spark, folder, "a", datetime(2024, 1, run), run)) == 1
    assert jobs_of(spark, f"{folder}-r", lambda: jobs.read_watermark(spark, folder, "a")) == 2  # of which one reads columns
    assert jobs.read_watermark(spark, folder, "a") == (datetime(2024, 1, 2, tzinfo=timezone.utc), 2)


def test_written_rows_are_counted_together(spark, folder):
    """One query for all tables; rows that are not live do not count, nor do those of other runs."""
    s = jobs.Settings(folder)
    for name, n in (("x", 3), ("y", 5)):
        df = spark.range(n).withColumnRenamed("id", "k")
        write_table(df, s.table(name), "k", 1)
        replace_in_table(df.where("k > 0"), df.where("k < 3"), s.table(name), "k", 2)
    counted = []
    assert jobs_of(spark, f"{folder}-c", lambda: counted.append(jobs._written(spark, s, ["x", "y"], 2))) <= 2
    assert counted == [{"x": 2, "y": 4}]
