"""What the character network adds to the patterns."""

import os
import sys

import numpy as np

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

from kinfold.llm import secret_cnn  # noqa: E402

PLAIN = " ".join(f"word{i}" for i in range(12))


def hexes(rng, n):
    return "".join(rng.choice(list("0123456789abcdef"), n))


def test_what_a_pattern_covers_in_part_goes_whole(spark):
    rng = np.random.default_rng(0)
    rows = [(i, f"{PLAIN} password={hexes(rng, 20)} and user{i}@mail{i % 10}.example.com in 10.2.{i}.117 there") for i in range(300)]
    rows += [(1000 + i, f"{PLAIN} the key GHJK7-{hexes(rng, 20)}-XYZ9Q there") for i in range(200)]
    rows += [(2001, f"{PLAIN} plain.words.only.here and more")]
    clean = {r.doc_id: r.text for r in secret_cnn.redact(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert sum("GHJK7" in clean[1000 + i] or "XYZ9Q" in clean[1000 + i] for i in range(200)) <= 10
    assert clean[2001] == rows[-1][1] and all(f"10.2.{i}.117" in clean[i] for i in range(300))


def test_what_follows_a_name_does_not_count_against_it(spark):
    rng = np.random.default_rng(1)
    rows = [(i, f"{PLAIN} passphrase={hexes(rng, 9).upper()}Z{hexes(rng, 8).upper()} and host{i}.example.com") for i in range(20)]
    found = secret_cnn.examples(spark.createDataFrame(rows, "doc_id bigint, text string"), "doc_id").collect()
    inside = ["".join(chr(c - 128) for c in r.codes if c >= 128) for r in found]
    assert sorted(inside) == sorted(f"host{i}.example.com" for i in range(20)) and not any(r.label for r in found)


def test_the_threshold_keeps_the_recall():
    rng = np.random.default_rng(2)
    y = np.arange(2000) % 2
    logit = np.where(y == 1, rng.normal(0.5, 1.5, 2000), rng.normal(-0.5, 1.5, 2000))
    network = secret_cnn.CharacterNetwork()
    network.calibrate(logit, y, 0.98)
    assert np.mean(network._calibrated(logit[y == 1]) >= network.threshold) >= 0.98


def test_spans_that_cover_a_candidate_together():
    spans = [("assign", 2, 9), ("hex", 5, 30)]
    assert secret_cnn._covered(spans, 4, 30) and secret_cnn._covered(spans, 2, 9)
    assert not secret_cnn._covered(spans, 1, 9) and not secret_cnn._covered(spans, 4, 31)


def test_names_of_secrets():
    for text in ("passphrase=Q9f8e7d6c5b4a392", "my secret is Q9f8e7d6c5b4a392", 'pwd: "Q9f8e7d6c5b4a392', "api key Q9f8e7d6c5b4a392"):
        assert secret_cnn.named(text, *secret_cnn.candidates(text)[-1])
    text = "the passage at host12.example.com"
    assert not secret_cnn.named(text, *secret_cnn.candidates(text)[-1])


def test_all_documents_give_examples_and_many_tasks_learn_them(spark):
    rng = np.random.default_rng(3)
    mails = [f"{PLAIN} user{i}@mail{i % 10}.example.com there" for i in range(3500)]
    keys = [f"{PLAIN} the key GHJK7-{hexes(rng, 20)}-XYZ9Q there" for _ in range(3500)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(mails + keys)], "doc_id bigint, text string")
    assert secret_cnn.examples(docs, "doc_id").count() == 7000
    one, again = (secret_cnn.learn(docs, share=2000) for _ in range(2))
    assert (one.state() == again.state()).all() and one.threshold == again.threshold
    unseen = [f"{PLAIN} the key GHJK7-{hexes(rng, 20)}-XYZ9Q there" for _ in range(200)]
    _, learned = secret_cnn.Scanner(one)(unseen + [f"{PLAIN} user{i}@mail{i % 10}.example.com there" for i in range(9000, 9200)])
    assert sum(map(bool, learned[:200])) >= 190 and sum(map(bool, learned[200:])) <= 4


def test_the_threshold_of_stored_examples_is_that_of_calibrate(spark):
    rng = np.random.default_rng(4)
    network = secret_cnn.CharacterNetwork()
    x = rng.integers(32, 250, (300, secret_cnn.BEFORE + secret_cnn.INSIDE + secret_cnn.AFTER))
    y = np.arange(300) % 3 // 2
    rows = [(bytearray(r.astype(np.uint8).tobytes()), int(k)) for r, k in zip(x, y, strict=True)]
    secret_cnn._calibrate(network, spark.createDataFrame(rows, "codes binary, label int").coalesce(1), 0.9)
    got = network.slope, network.shift, network.threshold
    network.calibrate(network.logits(x), y, 0.9)
    assert np.allclose(got, (network.slope, network.shift, network.threshold), rtol=1e-6, atol=1e-6)
