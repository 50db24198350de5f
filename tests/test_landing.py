"""One reading of a topic: every line in one place, also when a batch is repeated."""

import json
import math
import os
import sys
from collections import Counter

import pytest
from test_jobs import Bank

from kinfold.operators.quality import QualityError
from kinfold.plans import jobs
from kinfold.schemas import ACCOUNT
from kinfold.streaming import Landing, batch_log, land, read_lines, staged

module = sys.modules["kinfold.streaming.land"]  # its name in the package is that of its function


def line(ident, when, amount=1.0):
    payload = {"account_id": f"A{ident}", "customer_id": "C1", "balance": amount, "status": "ACTIVE"}
    return json.dumps({"event_id": ident, "event_time": when, "op_type": "INSERT", "payload": json.dumps(payload)})


class Topic:
    def __init__(self, spark, folder, lateness="10 minutes", mode="global"):
        self.spark, self.folder, self.n, self.args = spark, folder, 0, (lateness, mode)
        self.to = Landing(*[f"{folder}/{x}" for x in ("staging", "quarantine", "late", "log")])
        os.makedirs(f"{folder}/in")

    def send(self, *lines):
        with open(f"{self.folder}/in/{self.n}.txt", "w") as f:
            f.write("\n".join(lines))
        self.n += 1

    def run(self):
        query = land(read_lines(self.spark, f"{self.folder}/in"), ACCOUNT, self.to, f"{self.folder}/cp", *self.args)
        query.awaitTermination()
        return query

    def ids(self):
        return sorted(r.event_id for r in staged(self.spark, self.to.staging).collect())

    def counts(self):
        return [tuple(r)[:5] for r in batch_log(self.spark, self.to).orderBy("batch").collect()]


def test_every_line_is_counted_once(spark, folder):
    t = Topic(spark, folder)
    t.send(line("a", "2026-01-01T10:00:00"), line("b", "2026-01-01T11:00:00"), line("b", "2026-01-01T11:00:00"), "no event", line("n", "never"))
    t.run()
    t.send(line("c", "2026-01-01T10:49:59"), line("d", "2026-01-01T10:50:00"), line("a", "2026-01-01T12:00:00"), line("n", "never"), "{")
    query = t.run()
    assert t.ids() == ["a", "b", "d", "n"]
    #                    lines staged repeated late malformed
    assert t.counts() == [(5, 3, 1, 0, 1), (5, 1, 2, 1, 1)]
    assert [r.event_id for r in spark.read.parquet(t.to.late).collect()] == ["c"]
    assert sorted(r.value for r in spark.read.parquet(t.to.quarantine).collect()) == ["no event", "{"]
    assert not query.lastProgress["stateOperators"]


@pytest.mark.parametrize("mode", ["global", "within_watermark"])
def test_a_copy_far_behind_the_horizon_is_dropped_without_state(spark, folder, mode):
    t = Topic(spark, folder, "1 minute", mode)
    for k in range(4):
        t.send(line(f"e{k}", f"2026-01-0{k + 1}T10:00:00"))
        t.run()
    t.send(line("e0", "2026-01-01T10:00:00"), line("e3", "2026-01-04T10:00:00"), line("e1", "2026-01-09T00:00:00"))
    query = t.run()
    assert t.ids() == ["e0", "e1", "e2", "e3"] and t.counts()[-1][:4] == (3, 0, 2, 1)
    assert not query.lastProgress["stateOperators"]


@pytest.mark.parametrize("broken", ["_not_staged", "log_schema"])
def test_a_batch_that_fails_between_its_outputs_is_repeated(spark, folder, monkeypatch, broken):
    t = Topic(spark, folder)
    t.send(line("a", "2026-01-01T10:00:00"), "no event")
    t.run()
    t.send(line("a", "2026-01-01T10:00:00"), line("b", "2026-01-01T11:00:00"), line("c", "2025-01-01T11:00:00"), "no event either")
    real, calls = getattr(module, broken), []

    def once(*args):
        calls.append(args)
        # The log is asked for its schema when it is read; it is written with the columns of the events.
        if broken == "_not_staged" or args != ((),):
            monkeypatch.setattr(module, broken, real)
            raise RuntimeError("the executor is lost")
        return real(*args)

    monkeypatch.setattr(module, broken, once)
    with pytest.raises(Exception, match="the executor is lost"):
        t.run()
    t.run()
    assert t.ids() == ["a", "b"] and t.counts() == [(2, 1, 0, 0, 1), (4, 1, 1, 1, 1)]
    assert spark.read.parquet(t.to.quarantine).count() == 2 and spark.read.parquet(t.to.late).count() == 1


def test_an_empty_delivery(spark, folder):
    t = Topic(spark, folder)
    t.send("")
    t.send("nothing")
    t.run()
    assert staged(spark, t.to.staging).count() == 0 and t.counts()[0][1:] == (0, 0, 0, t.counts()[0][0])


def test_unknown_mode(spark, folder):
    with pytest.raises(ValueError):
        land(None, ACCOUNT, None, "", mode="sometimes")


# The gate
def test_malformed_lines_block_until_accepted_or_few(spark, folder):
    bank = Bank(spark, folder, seed=6)
    bank.ingest(bank.wave(5))
    with open(f"{folder}/in/loans/broken.txt", "w") as f:
        f.write("{not json")
    bank.ingest([])
    for _ in range(2):
        with pytest.raises(QualityError, match=r"1 failed check\(s\)\n\[loans\] malformed_lines : 1"):
            jobs.validate(spark, bank.s)
    assert Counter(r.passed for r in jobs.validate(spark, jobs.Settings(bank.s.base, malformed_share=0.2)).collect())[False] == 0
    jobs.validate(spark, bank.s)  # the run that passed has taken note of it
    with open(f"{folder}/in/loans/more.txt", "w") as f:
        f.write("}")
    bank.ingest([])
    with pytest.raises(QualityError):
        jobs.validate(spark, bank.s)
    jobs.accept_malformed(spark, bank.s, "loans")
    jobs.validate(spark, bank.s)


# Totals
def test_later_runs_read_no_facts(spark, folder, monkeypatch):
    bank = Bank(spark, folder, seed=8)
    bank.ingest(bank.wave(20))
    jobs.run_all(spark, bank.s)
    with monkeypatch.context() as m:
        m.setattr(jobs, "facts", None)
        bank.ingest(bank.wave(8))
        jobs.run_all(spark, bank.s)
    bank.check()


def test_amounts_that_no_sum_can_hold(spark, folder):
    bank = Bank(spark, folder, seed=1)
    bank.ingest([bank.customer(i) for i in range(4)] + [bank.loan(1, 3)])

    def balance(account, owner, amount):
        _, event = bank.account(account, owner)
        payload = json.loads(event["payload"]) | {"balance": amount}
        return "accounts", event | {"payload": json.dumps(payload)}

    bank.ingest([balance(1, 1, 5.25), balance(2, 2, 1e30), balance(3, 2, 7.5)])
    jobs.run_all(spark, bank.s)
    totals = {r.customer_id: r.total_balance for r in jobs.profile_table(spark, bank.s).collect()}
    assert totals["C001"] == 5.25 and math.isclose(totals["C002"], 1e30) and totals["C003"] == 0
    bank.ingest([balance(2, 1, 0.5)])  # it moves, and its amount becomes small
    jobs.run_all(spark, bank.s)
    totals = {r.customer_id: r.total_balance for r in jobs.profile_table(spark, bank.s).collect()}
    assert totals["C001"] == 5.75 and totals["C002"] == 7.5
    bank.check()
