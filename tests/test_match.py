import itertools
import random

import pytest
from conftest import distance, plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinfold.functions import edit_distance, own_pieces, possible_pieces, with_deletions
from kinfold.operators import match
from kinfold.operators.match import assign_golden, match_edges, match_pairs, one_hop

SCHEMA = "customer_id string, first_name string, last_name string, email string, phone string"


def people(n, seed, letters="ab"):
    r = random.Random(seed)
    out = []
    for i in range(n):
        name = "".join(r.choice(letters) for _ in range(r.randint(1, 6)))
        email = r.choice(["x", "y", "", None])
        phone = r.choice(["p", None] + [str(i)] * 3)
        out.append((f"C{i:03d}", r.choice([name, None]) if i % 9 == 0 else name, name[::-1], email, phone))
    return out


def true_pairs(data):
    out = set()
    for a, b in itertools.combinations(sorted(data), 2):
        if None in (a[1], a[2], b[1], b[2]):
            continue
        same = any(a[k] is not None and a[k] == b[k] for k in (3, 4))
        if same and distance(f"{a[1]} {a[2]}", f"{b[1]} {b[2]}") <= 2:
            out.add((a[0], b[0]))
    return out


def direct(data, pairs):
    golden = {d[0]: d[0] for d in data}
    for a, b in pairs:
        golden[b] = min(golden[b], a)
    return golden


def reachable(data, pairs):
    golden = {d[0]: d[0] for d in data}
    changed = True
    while changed:
        changed = False
        for a, b in pairs:
            low = min(golden[a], golden[b])
            if golden[a] != low or golden[b] != low:
                golden[a] = golden[b] = low
                changed = True
    return golden


def golden_of(df):
    return {r.customer_id: r.golden_customer_id for r in df.collect()}


def test_edit_distance(spark):
    df = spark.createDataFrame(
        [("Jon Doe", "John Doe", 1), ("Alice", "Alice", 0), ("abc", "xyz", 3), (None, "x", 9999),
         ("naïve", "naive", 1)],
        "s1 string, s2 string, d int",
    )
    assert all(r.d == r.got for r in df.withColumn("got", edit_distance("s1", "s2")).collect())


def test_shared_golden_id(spark):
    df = spark.createDataFrame(
        [
            ("K1", "Marta", "Olsen", "m.o@post.example", "070"),
            ("K2", "Martha", "Olsen", "m.o@post.example", "070"),
            ("K3", "Pavel", "Novak", "pn@post.example", "071"),
        ],
        SCHEMA,
    )
    assert golden_of(assign_golden(df)) == {"K1": "K1", "K2": "K1", "K3": "K3"}


def test_chain(spark):
    """A-B and B-C match, A-C do not."""
    df = spark.createDataFrame(
        [("A", "Jo", "Do", "m", None), ("B", "Joan", "Do", "m", "7"), ("C", "Joanna", "Do", None, "7")],
        SCHEMA,
    )
    assert golden_of(assign_golden(df)) == {"A": "A", "B": "A", "C": "B"}
    assert golden_of(assign_golden(df, "transitive")) == {"A": "A", "B": "A", "C": "A"}


def test_nulls_never_match_and_empty_strings_do(spark):
    df = spark.createDataFrame(
        [
            ("1", "A", "B", None, None), ("2", "A", "B", None, None),
            ("3", "A", "B", "", None), ("4", "A", "B", "", None),
            ("5", None, "B", "z", None), ("6", None, "B", "z", None),
        ],
        SCHEMA,
    )
    assert rows(match_pairs(df)) == [("3", "4")]


@pytest.mark.parametrize("min_rows,seed", [(1, 1), (4, 2), (10**6, 3)])
def test_against_brute_force(spark, min_rows, seed):
    data = people(120, seed)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    pairs = true_pairs(data)
    assert set(rows(match_pairs(df, min_rows))) == pairs
    assert golden_of(assign_golden(df, "one_hop", min_rows)) == direct(data, pairs)
    assert golden_of(assign_golden(df, "transitive", min_rows)) == reachable(data, pairs)


NAMES = st.lists(st.text(alphabet="ab:1", max_size=9), min_size=2, max_size=25, unique=True)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(NAMES)
def test_near_names_share_a_piece(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    a = df.select(F.col("n").alias("a"), F.explode(own_pieces(F.col("n"))).alias("p"))
    b = df.select(F.col("n").alias("b"), F.explode(possible_pieces(F.col("n"))).alias("p"))
    met = {tuple(r) for r in a.join(b, "p").select("a", "b").distinct().collect()}
    for x in names:
        for y in names:
            if x != y and distance(x, y) <= 2:
                assert (x, y) in met or (y, x) in met


def test_long_names(spark):
    base = "x" * 40 + "y" * 40
    names = [base, base[:-1] + "z", base[1:] + "qq", base + "abc"]
    data = [(str(i), n, "", "m", None) for i, n in enumerate(names)]
    got = rows(match_pairs(spark.createDataFrame(data, SCHEMA), 1))
    assert set(got) == true_pairs(data)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(NAMES)
def test_near_names_share_a_rest(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "n string")
    a = with_deletions(df, "n", every=True).select(F.col("n").alias("a"), "rest")
    b = with_deletions(df, "n", every=False).select(F.col("n").alias("b"), "rest")
    met = {tuple(r) for r in a.join(b, "rest").select("a", "b").distinct().collect()}
    for x in names:
        for y in names:
            if len(x) <= len(y) and distance(x, y) <= 2:
                assert (x, y) in met


@pytest.mark.parametrize("few,short,seed", [(0, 99, 1), (0, 3, 2), (0, 0, 3), (5, 6, 4)])
def test_every_way_finds_all_pairs(spark, monkeypatch, few, short, seed):
    """Blocks of all sizes and names of all lengths, by deletions, by rare pieces and by both."""
    monkeypatch.setattr(match, "FEW", few)
    monkeypatch.setattr(match, "SHORT", short)
    data = people(100, seed) + [
        (f"L{i:02d}", "common beginning of a name " + f"{i * i * 37 % 101:03d}", "with a common end" if i % 2 else "end", "x" if i % 3 else "y", None)
        for i in range(40)
    ]
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    pairs = true_pairs(data)
    assert set(rows(match_pairs(df, 4))) == pairs
    assert golden_of(assign_golden(df, "transitive", 4)) == reachable(data, pairs)


def test_names_that_meet_are_few(spark):
    """Names of one block that share a beginning and an end: ten times the names, about ten times the meetings."""
    met = []
    for n in (200, 2000):
        r = random.Random(n)
        data = [(f"C{i:05d}", "Customer", "".join(r.choice("0123456789") for _ in range(9)) + " Ltd", "m", None) for i in range(n)]
        names = match._names(match._entries(spark.createDataFrame(data, SCHEMA)))
        met.append(match._met(names, 10**6).count())
        assert met[-1] < 10 * n
    long = [(f"C{i:05d}", "A long common name", f"{r.randrange(10**6):06d} and its end", "m", None) for i in range(1000)]
    names = match._names(match._entries(spark.createDataFrame(long, SCHEMA)))
    assert match._met(names, 10**6).count() < 30 * 1000  # of 499,500 pairs


def test_a_long_name_costs_few_rows(spark):
    df = spark.createDataFrame([("q" * 200 + "w" * 200,), ("q",), ("",)], "n string")
    n = F.size(own_pieces(F.col("n"))) + F.size(possible_pieces(F.col("n")))
    assert all(r[0] <= 48 for r in df.select(n).collect())


def test_copies_do_not_multiply(spark):
    """A third of all customers are copies of one person in one block."""
    n = 3000
    df = spark.range(n).select(
        F.format_string("C%05d", "id").alias("customer_id"),
        F.when(F.col("id") % 3 == 0, "Ann").otherwise(F.concat(F.lit("N"), F.col("id") * 7919)).alias("first_name"),
        F.lit("Lee").alias("last_name"),
        F.lit("none").alias("email"),
        F.col("id").cast("string").alias("phone"),
    )
    edges = match_edges(df)
    copies = df.where("first_name = 'Ann'").count()
    golden = assign_golden(df, "transitive").where("first_name = 'Ann'")
    assert golden.select("golden_customer_id").distinct().count() == 1
    names = n - copies + 1
    assert edges.distinct().count() < copies + names * 300


def test_one_phone_for_all(spark):
    """1,000 customers with one phone: pairs with a typo are found, others are not."""
    r = random.Random(5)
    data = []
    for i in range(500):
        name = "".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(10))
        at = r.randrange(10)
        data.append((f"A{i:04d}", name, "Q", f"{i}@a", "1112223333"))
        data.append((f"B{i:04d}", name[:at] + "é" + name[at + 1:], "Q", f"{i}@b", "1112223333"))
    golden = golden_of(assign_golden(spark.createDataFrame(data, SCHEMA)))
    assert all(golden[f"B{i:04d}"] == f"A{i:04d}" for i in range(500))


def test_plans_compare_no_product(spark):
    df = spark.createDataFrame(people(30, 1), SCHEMA)
    for out in (match_pairs(df), one_hop(df), match_edges(df)):
        text = plan(out)
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython"):
            assert bad not in text


def test_unknown_closure(spark):
    with pytest.raises(ValueError):
        assign_golden(spark.createDataFrame(people(3, 1), SCHEMA), "two_hops")


def test_block_sizes(spark):
    people = [
        ("1", "Ann", "A", "x@x", "0"), ("2", "Ann", "A", "x@x", "0"), ("3", "Bob", "B", "y@y", "0"),
        ("4", None, "B", "y@y", "0"), ("5", "Eve", "E", None, ""), ("6", "Eve", "E", None, ""),
    ]
    df = spark.createDataFrame(people, "customer_id string, first_name string, last_name string, email string, phone string")
    assert rows(match.block_sizes(df)) == [("email", "x@x", 2, 1), ("phone", "", 2, 1), ("phone", "0", 3, 2)]
    assert rows(match.block_sizes(df, 3)) == [("phone", "0", 3, 2)]
    assert rows(match.block_sizes(df.limit(0))) == []
