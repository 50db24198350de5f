import json
import os

import pytest
from conftest import rows
from pyspark.sql import functions as F

from kinfold.schemas import ACCOUNT, CUSTOMER, LOAN, MASTER, MASTER_COLUMNS
from kinfold.sources.files import parse_cdc, read_master, split_malformed, to_cdc, write_master
from kinfold.streaming import dedup_stream, ingest, quarantine_stream, read_kafka, read_lines, staged

TIME = "2026-03-18T01:00:00"
SAMPLES = [
    (CUSTOMER, {
        "customer_id": "K-07", "first_name": "Ines", "last_name": "Moreau", "email": "ines@post.example",
        "phone": "0331234", "address": "9 Quai Nord", "city": "Nantes", "state": "PDL",
        "country": "FRA", "updated_at": TIME,
    }),
    (ACCOUNT, {
        "account_id": "K-07-a", "customer_id": "K-07", "account_type": "CURRENT", "balance": 812.375,
        "status": "ACTIVE", "updated_at": TIME,
    }),
    (LOAN, {
        "loan_id": "K-07-z", "customer_id": "K-07", "loan_type": "BOAT", "loan_amount": 17250.0,
        "loan_status": "CLOSED", "emi_amount": 431.5, "updated_at": TIME,
    }),
]


def line(event_id, time, payload, op="INSERT"):
    return json.dumps({"event_id": event_id, "event_time": time, "op_type": op, "payload": json.dumps(payload)})


@pytest.mark.parametrize("schema,payload", SAMPLES, ids=["customer", "account", "loan"])
@pytest.mark.parametrize("kind", ["string", "binary"])
def test_parse(spark, schema, payload, kind):
    raw = spark.createDataFrame([(line("n-1", TIME, payload),)], "value string")
    row = parse_cdc(raw.select(F.col("value").cast(kind)), schema).first().asDict()
    assert (row.pop("event_id"), row.pop("op_type")) == ("n-1", "INSERT")
    assert row.pop("event_time").isoformat() == TIME
    assert row == payload


def test_envelope(spark):
    df = spark.createDataFrame(
        [("e1", "2026-03-18 01:00:00.123456", "UPDATE", "K-07", None)],
        "event_id string, event_time string, op_type string, customer_id string, email string",
    )
    event = json.loads(to_cdc(df).first().value)
    assert list(event) == ["event_id", "event_time", "op_type", "payload"]
    assert event["op_type"] == "UPDATE"
    assert json.loads(event["payload"]) == {"customer_id": "K-07", "email": None}
    back = parse_cdc(to_cdc(df), CUSTOMER).first()
    assert back.event_time.microsecond == 123456 and back.customer_id == "K-07"


def test_malformed(spark):
    good = line("e1", TIME, {"customer_id": "C"})
    bad = ["{not json", "", json.dumps({"op_type": "INSERT"})]
    raw = spark.createDataFrame([(v,) for v in [good, *bad]], "value string")
    events, quarantine = split_malformed(raw, CUSTOMER)
    assert [r.customer_id for r in events.collect()] == ["C"]
    assert {r.value for r in quarantine.collect()} == set(bad)
    no_time = spark.createDataFrame([(line("e", "nope", {"customer_id": "C"}),)], "value string")
    assert parse_cdc(no_time, CUSTOMER).first().event_time is None


def test_payload_as_object(spark):
    text = json.dumps({"event_id": "e", "event_time": TIME, "op_type": "X", "payload": {"account_id": "A", "balance": 2.5}})
    row = parse_cdc(spark.createDataFrame([(text,)], "value string"), ACCOUNT).first()
    assert (row.account_id, row.balance) == ("A", 2.5)


def test_master_keeps_text(spark, folder):
    data = [tuple(f"{c}, \"x\"" if c == "address" else f"007{i}" for c in MASTER_COLUMNS) for i in range(3)]
    write_master(spark.createDataFrame(data, MASTER), folder + "/m")
    assert rows(read_master(spark, folder + "/m")) == sorted(data, key=repr)
    with open(folder + "/one.csv", "w") as f:
        f.write(",".join(MASTER_COLUMNS) + "\n" + "C,a,b,e,0123456789,\"1 St\nApt 2\",c,s,USA\n")
    row = read_master(spark, folder + "/one.csv", line_breaks=True).first()
    assert row.phone == "0123456789" and row.address == "1 St\nApt 2"


def test_master_is_read_by_name(spark, folder):
    names = [*reversed(MASTER_COLUMNS), "extra"]
    with open(folder + "/swapped.csv", "w") as f:
        f.write(",".join(names) + "\n" + ",".join(f"v-{n}" for n in names) + "\n")
    assert read_master(spark, folder + "/swapped.csv").first().asDict() == {c: f"v-{c}" for c in MASTER_COLUMNS}
    with open(folder + "/short.csv", "w") as f:
        f.write("customer_id,email\nC,e\n")
    with pytest.raises(ValueError, match="phone"):
        read_master(spark, folder + "/short.csv")


@pytest.mark.parametrize("mode", ["global", "within_watermark"])
def test_dedup_of_a_batch(spark, mode):
    raw = spark.createDataFrame([(line("a", TIME, {}),), (line("a", TIME, {}),), (line("b", None, {}),)], "value string")
    assert sorted(r.event_id for r in dedup_stream(parse_cdc(raw, ACCOUNT), mode=mode).collect()) == ["a", "b"]


class Feed:
    """Files that arrive one after another, and the table they are ingested into."""

    def __init__(self, spark, folder, lateness="10 minutes", mode="global"):
        self.spark, self.folder, self.lateness, self.mode = spark, folder, lateness, mode
        self.n = 0
        os.makedirs(folder + "/in")

    def arrive(self, *events):
        self.n += 1
        with open(f"{self.folder}/in/{self.n}.txt", "w") as f:
            f.write("\n".join(
                e if isinstance(e, str) else line(e[0], e[1], {"account_id": e[0], "balance": float(self.n)})
                for e in events
            ))
        self.run()

    def run(self):
        raw = read_lines(self.spark, self.folder + "/in", files_per_trigger=1)
        ingest(raw, ACCOUNT, self.folder + "/out", self.folder + "/cp", self.lateness, self.mode).awaitTermination()

    def ids(self):
        return sorted(r.event_id for r in staged(self.spark, self.folder + "/out").collect())


def at(minute, hour=10):
    return f"2026-03-18T{hour:02d}:{minute:02d}:00"


def test_duplicates_late_rows_and_restarts(spark, folder):
    feed = Feed(spark, folder)
    feed.arrive(("a", at(0)), ("a", at(0)), ("b", at(30)), "{broken")
    feed.arrive(("b", at(30)), ("c", at(31)))
    feed.arrive(("late", at(5)), ("d", at(25)), ("untimed", None), ("a", at(32)))
    feed.run()
    assert feed.ids() == ["a", "b", "c", "d", "untimed"]
    arrived = [r.arrived_at for r in staged(spark, folder + "/out").orderBy("balance").collect()]
    assert len(set(arrived)) == 3 and arrived == sorted(arrived)


def test_bounded_state_lets_a_very_late_copy_pass(spark, folder):
    feeds = {m: Feed(spark, f"{folder}/{m}", mode=m) for m in ("global", "within_watermark")}
    for f in feeds.values():
        f.arrive(("a", at(0)))
        f.arrive(("a", at(5)), ("b", at(0, 11)))
        f.arrive(("c", at(0, 12)))
        f.arrive(("d", at(0, 13)))
        f.arrive(("a", at(1, 13)))
    assert feeds["global"].ids() == ["a", "b", "c", "d"]
    assert feeds["within_watermark"].ids() == ["a", "a", "b", "c", "d"]
    with pytest.raises(ValueError):
        dedup_stream(parse_cdc(spark.createDataFrame([("{}",)], "value string"), ACCOUNT), mode="other")


def test_quarantine_stream(spark, folder):
    os.makedirs(folder + "/in")
    with open(folder + "/in/1.txt", "w") as f:
        f.write("{broken\n" + line("e", TIME, {}) + "\nalso broken")
    raw = read_lines(spark, folder + "/in")
    quarantine_stream(raw, ACCOUNT, folder + "/q", folder + "/cp").awaitTermination()
    assert rows(staged(spark, folder + "/q")) == [("also broken",), ("{broken",)]


def test_kafka_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        read_kafka(spark, "nowhere:9092", "cdc.customers")
