"""Stages of the pipeline on rows that were lost before."""

import os
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
given = pytest.mark.skipif(not os.path.isdir(SF), reason="the given tables are not there")


@given
def test_a_row_goes_for_its_own_text_only(spark):
    passage = max((r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()), key=lambda t: len(t or ""))
    rows = [(None, passage), (None, "clean without id"), (None, None), (1, "lead " + passage), (1, "clean with the same id"), (2, "clean")]
    out = corpus_pipeline.decontamination(spark, spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id bigint, text string, _n int, at string, h int"), SF)
    assert out.columns == ["doc_id", "text", "_n", "at", "h"]
    assert sorted(str(r.text) for r in out.collect()) == ["None", "clean", "clean with the same id", "clean without id"]


def test_the_bound_of_the_language_follows_the_number_of_languages(spark):
    rng = np.random.default_rng(3)
    words = [["".join(rng.choice(list("abcdefghijklmnopqrstuvwx"[2 * k : 2 * k + 2]), 9)) for _ in range(300)] for k in range(12)]
    rows = [(100 * k + i, " ".join(rng.choice(words[k], 60)), f"l{k:02}") for k in range(12) for i in range(25)]
    mixed = [(5000 + i, " ".join(w for k in range(6) for w in rng.choice(words[(i + k) % 12], 10)), None) for i in range(12)]
    docs = spark.createDataFrame([*rows, *mixed, (6000, "1234 !!", None)], "doc_id bigint, text string, lang string")
    out = {r.doc_id for r in corpus_pipeline.language_id(spark, docs, "").collect()}
    assert out == {r[0] for r in rows + mixed}
