"""Documents to training tokens: each stage works on all that the one before it kept.

1. documents whose language is not recognised go;
2. of each group of near-duplicates (SimHash fingerprints of three-word shingles, linked within two bits) one document
   stays;
3. documents that hold a benchmark item go;
4. secrets in the texts are replaced;
5. texts become token ids, which decode to the normalised text.

Defined results: a NULL or empty text has no letters, so stage 1 drops it; equal rows are near-duplicates, of which one
stays; rows without an id, or with the same one, are judged by their own texts in every stage; other columns,
whatever their names, are carried along; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from kinfold.llm import bpe_automaton, decontaminate, language_gru, secret_cnn, simhash
from kinfold.llm.catalogue import tokenizer_path
from kinfold.llm.common import ship, table
from kinfold.sources.scratch import cut_lineage

#: A language is recognised if its score is so many times that of a guess; 0.3 with four languages.
TIMES_CHANCE = 1.2

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return language_gru.known_language(docs, times_chance=TIMES_CHANCE)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return simhash.first_of_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_rows(docs, table(spark, sf_dir, "benchmark"))


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return secret_cnn.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    ship(spark)
    return bpe_automaton.encode(docs, tokenizer_path(), "doc_id", "lang", "source")


STAGES: list[tuple[str, Stage]] = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secret_scan", secret_scan),
    ("token_ids", token_ids),
]

#: Networks and tokens are beyond SQL; tests/llm compares the stages with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = cut_lineage(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
