"""Mixing sources to target weights by words.

Each source gets a share of all words by its weight, at most ``most`` times what it has; what it cannot take is
shared again among the others. Documents get a hash-random key, are range-sorted by source and key, and the words
before each in its source are a prefix sum: partial sums of the sorted partitions first, then a running sum
inside each. A source's budget is whole passes over all its documents and a last pass that ends after an exact number of
words, inside a document if need be.

A source with a third of all rows is many ranges of the sort, since the key tells its documents apart; the
sums that are joined have one row for each source and partition that meet. The texts are read once; only ids, sources, sizes
and keys are shuffled. Keys depend on id and text, so reruns agree.

Defined results: a NULL or empty text has no words and gives none; a NULL source is a source of its own, the last; NULL or
repeated ids are told apart by their texts, and equal rows each get a row, of which one or the other may be
the one that is cut; a source without words has target 0; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.llm.order import in_order, places, starts
from kinfold.sources.scratch import cut_lineage

WEIGHTS = (1, 2, 3)
#: A document is taken so many times at most.
MOST = 3
_SPACE = r"\x20\x09-\x0D"


def _key(id_column: str, text: str) -> Column:
    """The same for equal rows in every run, and without order otherwise."""
    named = F.coalesce(F.col(id_column).cast("string"), F.lit(""))
    return F.md5(F.concat(named, F.lit(":"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))).cast("binary"))


def sizes(docs: DataFrame, id_column: str, source: str, text: str, *keep: str) -> DataFrame:
    """Id, source, words and key of every document, written to the shared folder."""
    words = F.coalesce(F.regexp_count(text, F.lit(f"[^{_SPACE}]+")), F.lit(0)).cast("bigint")
    narrow = docs.select(
        *keep, F.col(id_column).alias("_id"), F.col(source).alias("_source"), words.alias("_size"),
        _key(id_column, text).alias("_key"),
    )
    return cut_lineage(narrow.withColumn("_n", F.monotonically_increasing_id()), "sizes")


def _whole(value: int) -> Column:
    return F.lit(Decimal(value)).cast("decimal(38,0)")


def targets(sized: DataFrame, weights: Sequence[int] = WEIGHTS, most: int = MOST, total: int | None = None) -> DataFrame:
    """``(_source, _source_size, _target, _budget)``: words to take from every source, exact and in whole words.

    ``total`` is what all sources give together, by default as many words as there are. Every round reads two sums over
    the sources, the words left to share and the weight of the sources below their limit, until they stay.
    """
    per_source = cut_lineage(sized.groupBy("_source").agg(F.sum("_size").alias("_source_size")), "sources")
    by_name = [F.col("_source").isNull().asc(), F.col("_source").asc()]
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("_place") % len(weights) + 1).cast("int"))
    ranked = cut_lineage(
        places(per_source, by_name, "ranked", "_place").withColumn("_weight", weight.cast("bigint")), "weights"
    )
    cap = F.col("_source_size").cast("decimal(20,0)") * F.lit(most)
    first = ranked.agg(F.sum("_source_size").alias("words"), F.sum("_weight").alias("weight")).first()
    every = first.words or 0 if total is None else total
    left, weight_left = every, first.weight or 1
    while True:
        share = _whole(left) * F.col("_weight").cast("decimal(10,0)")
        full = cap * _whole(weight_left) < share if weight_left else F.lit(True)
        now = ranked.agg(
            F.sum(F.when(full, cap)).alias("full"), F.sum(F.when(~full, F.col("_weight"))).alias("weight")
        ).first()
        after = every - int(now.full or 0), now.weight or 0
        if after == (left, weight_left) or not after[1]:
            break
        left, weight_left = after
    if not after[1]:  # all sources are at their limit
        full = F.lit(True)
    shared = share.cast("double") / F.lit(float(weight_left or 1))
    exact = F.floor(share / _whole(weight_left or 1))
    return ranked.select(
        "_source", "_source_size",
        F.when(full, cap.cast("double")).otherwise(shared).alias("_target"),
        F.when(full, cap).otherwise(exact).cast("bigint").alias("_budget"),
    )


def shares(
    docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text", weights: Sequence[int] = WEIGHTS,
    most: int = MOST, total: int | None = None, keep: Sequence[str] = (),
) -> DataFrame:
    """``(*keep, _id, _size, _source_size, _target, _epochs, _part_words)`` of every document: how often it is taken whole,
    and how many of its first words once more."""
    sized = sizes(docs, id_column, source, text, *keep)
    goal = cut_lineage(targets(sized, weights, most, total), "targets")
    order = [F.col("_source").isNull().asc(), F.col("_source").asc(), F.col("_key").asc(), F.col("_n").asc()]
    ordered = in_order(sized, order, "mixed")
    # One row for each source and partition that meet: words ahead, and the source's goal.
    ahead = starts(ordered.withColumnRenamed("_source", "_named"), F.col("_size"), ["_named"])
    ahead = ahead.join(goal, F.col("_named").eqNullSafe(F.col("_source"))).drop("_source")
    inside = Window.partitionBy("_part", "_source").orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    running = ordered.withColumn("_inside", F.coalesce(F.sum("_size").over(inside), F.lit(0)))
    met = running.withColumnRenamed("_part", "_at").join(
        ahead, (F.col("_at") == F.col("_part")) & F.col("_source").eqNullSafe(F.col("_named"))
    )
    some = F.col("_source_size") > 0
    epochs = F.when(some, F.expr("_budget div _source_size")).otherwise(0).cast("bigint")
    rest = F.when(some, F.col("_budget") % F.col("_source_size")).otherwise(0).cast("bigint")
    cut = F.greatest(F.lit(0), F.least(F.col("_size"), rest - F.col("_before") - F.col("_inside")))
    return met.select(
        *keep, "_id", "_size", "_source_size", "_target", epochs.alias("_epochs"), cut.cast("bigint").alias("_part_words")
    )


def mix(docs: DataFrame, id_column: str = "doc_id", source: str = "source", text: str = "text", **options) -> DataFrame:
    """The mix itself: the rows of ``docs`` with ``_epoch``, each as often as it is taken; in its last pass a
    document that is cut has its first words only, with the space between them as it was.

    The rows are written with a number of their own first, so equal ones are told apart.
    """
    names = docs.columns
    numbered = cut_lineage(
        docs.select(F.struct(*[F.col(c) for c in names]).alias("_row_of"), F.monotonically_increasing_id().alias("_number")),
        "numbered",
    )
    fields = [F.col(f"_row_of.{c}").alias(a) for c, a in ((id_column, "_i"), (source, "_s"), (text, "_t"))]
    taken = shares(numbered.select("_number", *fields), "_i", "_s", "_t", keep=["_number"], **options)
    taken = taken.select("_number", "_size", "_epochs", "_part_words").where("_epochs > 0 or _part_words > 0")
    passes = F.sequence(F.lit(1).cast("bigint"), F.col("_epochs") + F.when(F.col("_part_words") > 0, 1).otherwise(0))
    rows = numbered.join(taken, "_number").withColumn("_epoch", F.explode(passes))
    # Pieces are words with the space after them; what stands before the first word is a piece too.
    whole = F.col(f"_row_of.{text}")
    pieces = F.split(whole, f"(?<=[{_SPACE}])(?=[^{_SPACE}])")
    lead = F.when(whole.rlike(f"^[{_SPACE}]"), 1).otherwise(0)
    first = F.array_join(F.slice(pieces, F.lit(1), (F.col("_part_words") + lead).cast("int")), "")
    is_cut = (F.col("_epoch") > F.col("_epochs")) & (F.col("_part_words") < F.col("_size"))
    said = F.when(is_cut, first).otherwise(whole)
    return rows.select(*[said.alias(c) if c == text else F.col(f"_row_of.{c}").alias(c) for c in names], "_epoch")


def taken_words(docs: DataFrame, **options) -> DataFrame:
    """``(doc_id, size, source_size, target, taken)`` of every document."""
    rows = shares(docs, **options)
    return rows.select(
        F.col("_id").alias(options.get("id_column", "doc_id")), F.col("_size").alias("size"),
        F.col("_source_size").alias("source_size"), F.col("_target").alias("target"),
        (F.col("_epochs") * F.col("_size") + F.col("_part_words")).alias("taken"),
    )
