"""Text rules, and verdicts on hosts whose documents break them too often. DataFrame functions only.

Each document is judged by itself first (``measure``, ``failed``). Failures are then counted for
each host, the rate of a host is shrunk towards that of all hosts by a beta prior fitted to the
hosts' rates, and a host whose shrunk rate is above ``max_rate`` loses all its documents.

Defined results: a NULL text has no words; a NULL host is a host of its own; equal rows each count
and each get a row; an empty table gives an empty result; other columns are ignored. Two different
windows of one text would only be taken for equal if their 64-bit hashes were.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.llm.common import let
from kinfold.sources.scratch import cut_lineage

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEATED = 30
MAX_RATE = 0.5
#: Documents that the prior is worth at least, so that one failure alone condemns no host.
MIN_WEIGHT = 2.0


def _words(text: Column) -> Column:
    return F.filter(F.split(text, SPACE, -1), lambda w: w != "")


def _repeated(words: Column) -> Column:
    """Words covered by windows of ``WINDOW`` words that are found twice or more."""

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def starts(p: Column) -> Column:
            met = F.transform(
                p,
                lambda x, j: F.when(
                    (F.coalesce(F.get(p, j - 1)["h"] == x["h"], F.lit(False)))
                    | (F.coalesce(F.get(p, j + 1)["h"] == x["h"], F.lit(False))),
                    x["i"],
                ),
            )
            return F.sort_array(F.array_compact(met))

        return F.aggregate(
            let(placed, starts),
            F.struct(F.lit(0).alias("n"), F.lit(0).alias("end")),
            lambda a, s: F.struct(
                (a["n"] + F.lit(WINDOW) - F.greatest(F.lit(0), a["end"] - s)).alias("n"),
                (s + F.lit(WINDOW)).alias("end"),
            ),
            lambda a: a["n"],
        )

    hashes = F.transform(
        F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)),
        lambda i: F.xxhash64(F.slice(words, i, WINDOW)),
    )
    any_twice = let(
        hashes,
        lambda h: F.when(F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(0),
    )
    return F.when(F.size(words) > WINDOW, any_twice).otherwise(0)


def _lines(text: Column) -> Column:
    worded = F.filter(F.split(text, "\n", -1), lambda s: s.rlike(r"[^\x20\x09-\x0D]"))
    return let(worded, lambda s: F.size(s) - F.size(F.array_distinct(s)))


def measure(docs: DataFrame, *keep: str | Column) -> DataFrame:
    """``keep`` and, for each document, n_words, word_chars, n_symbols, n_dup_lines and
    n_repeat_words."""
    text = F.coalesce(F.col("text"), F.lit(""))
    counted = let(
        _words(text),
        lambda w: F.struct(
            F.size(w).cast("long").alias("n_words"),
            F.aggregate(w, F.lit(0).cast("long"), lambda n, x: n + F.length(x)).alias("word_chars"),
            _repeated(w).cast("long").alias("n_repeat_words"),
        ),
    )
    return docs.select(
        *keep,
        counted.alias("_c"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long").alias("n_symbols"),
        _lines(text).cast("long").alias("n_dup_lines"),
    ).select(
        *[k if isinstance(k, str) else k for k in _names(docs, keep)],
        "_c.n_words", "_c.word_chars", "n_symbols", "n_dup_lines", "_c.n_repeat_words",
    )


def _names(docs: DataFrame, keep) -> list[str]:
    return docs.select(*keep).columns


def failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words")
    )


def host_verdicts(judged: DataFrame, max_rate: float = MAX_RATE) -> DataFrame:
    """One row for each host: n_docs, n_failed, shrunk_rate, host_failed.

    ``judged`` has ``host`` and ``base_failed``. The prior beta(a, b) has the mean and variance of
    the hosts' rates, a host counting once; it is worth ``MIN_WEIGHT`` documents at least, and
    just that where the rates have no spread.
    """
    hosts = judged.groupBy("host").agg(
        F.count("*").alias("n_docs"), F.count_if("base_failed").alias("n_failed")
    )
    rate = F.col("n_failed") / F.col("n_docs")
    m, v = hosts.agg(F.avg(rate), F.var_pop(rate)).first()  # two numbers
    m, v = m or 0.0, v or 0.0
    weight = max(MIN_WEIGHT, m * (1 - m) / v - 1) if v > 0 else MIN_WEIGHT
    shrunk = (F.col("n_failed") + F.lit(m * weight)) / (F.col("n_docs") + F.lit(weight))
    return hosts.select(
        "host", "n_docs", "n_failed", shrunk.alias("shrunk_rate"), (shrunk > max_rate).alias("host_failed")
    )


def judge(docs: DataFrame, host: str = "source", max_rate: float = MAX_RATE) -> DataFrame:
    """Every document with its counts, ``base_failed``, ``host_failed`` and ``kept``.

    The counts are written to the shared folder once, for they are read twice: to add up hosts and
    to be joined with the verdicts. Only counts are shuffled, never texts; a host with very many
    documents is added up before the shuffle, and its part of the join is split by Spark.
    """
    counts = measure(docs, "doc_id", F.col(host).alias("host"))
    judged = cut_lineage(counts.withColumn("base_failed", failed()), "quality")
    verdicts = host_verdicts(judged, max_rate).select(F.col("host").alias("_host"), "host_failed")
    return (
        judged.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
        .drop("_host")
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_failed"))
    )
