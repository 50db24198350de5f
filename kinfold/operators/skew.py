"""Joins and aggregations that stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kinfold.functions import salt_of

HOT_ROWS = 1_000_000
#: With fewer rows to a hot key, hot keys can be as many as the rows of a large table.
MANY_HOT = 10_000


def large(df: DataFrame) -> DataFrame:
    """Marks a side of a join that grows with the input: both sides are sorted, and neither goes through the driver.

    Spark sends the smaller side of a join to all executors if it has up to ``spark.sql.autoBroadcastJoinThreshold`` bytes,
    but goes by compressed files and shuffles. Ids and names are several times larger as rows in the memory of the driver,
    where the sides of several joins meet.
    """
    return df.hint("merge")


def spread(rows: DataFrame, *by: str) -> DataFrame:
    """Into the full number of shuffle partitions: where a row costs far more work than moving it, neither the row groups of a
    file nor adaptive execution, which goes by bytes, should leave this work to too few tasks."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def hot_keys(df: DataFrame, keys: Sequence[str], min_rows: int = HOT_ROWS) -> DataFrame:
    """Every key with at least ``min_rows`` rows: at most one in so many rows of ``df``."""
    return (
        df.where(_all_present(keys))
        .groupBy(*keys)
        .agg(F.count("*").alias("n_rows"))
        .where(F.col("n_rows") >= min_rows)
    )


def salted_join(
    one: DataFrame,
    many: DataFrame,
    keys: str | Sequence[str],
    n_salts: int = 8,
    how: str = "left",
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """``one.join(many, keys, how)`` for inner and left, spreading hot keys of ``many``.

    Rows of ``many`` under a hot key get a salt from their own content, and the matching rows of
    ``one`` are repeated once per salt; all other keys keep one salt and one copy. Rows of a hot
    key that were repeated but found no partner under their salt are removed again: a hot key has
    a partner under some salt, or it would not be hot. Equal rows of ``many`` get equal salts.

    ``many`` is read twice, the first time only its keys, to count them; a costly one should be
    stored before. Whether the hot keys are broadcast is left to Spark only where they are few (``with_hot``).
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if how not in ("inner", "left"):
        raise ValueError("salted_join supports 'inner' and 'left'")
    return _salted(one, many, keys, hot_keys(many, keys, min_rows).select(*keys), n_salts, how, min_rows)


def with_hot(rows: DataFrame, hot: DataFrame, keys: str | Sequence[str], min_rows: int) -> DataFrame:
    """``rows`` with the columns of ``hot``, the keys with at least ``min_rows`` rows, or NULL."""
    return rows.join(hot if min_rows >= MANY_HOT else large(hot), keys, "left")


def _salted(
    one: DataFrame, many: DataFrame, keys: list[str], hot: DataFrame, n_salts: int, how: str, min_rows: int
) -> DataFrame:
    flagged = hot.withColumn("_hot", F.lit(True))
    content = [c for c, t in many.dtypes if "map<" not in t and "variant" not in t]
    spread = (
        with_hot(many, flagged, keys, min_rows)
        .withColumn("_salt", F.when(F.col("_hot"), salt_of(n_salts, *content)).otherwise(0))
        .withColumn("_matched", F.lit(True))
        .drop("_hot")
    )
    salts = F.when(F.col("_hot"), F.sequence(F.lit(0), F.lit(n_salts - 1)))
    copies = with_hot(one, flagged, keys, min_rows).withColumn(
        "_salt", F.explode(salts.otherwise(F.array(F.lit(0))))
    )
    joined = copies.join(large(spread), [*keys, "_salt"], how)
    if how == "left":
        joined = joined.where(F.col("_matched").isNotNull() | F.col("_hot").isNull())
    return joined.drop("_hot", "_salt", "_matched")


def lookup_join(
    many: DataFrame,
    one: DataFrame,
    keys: Sequence[str],
    weight: str,
    min_rows: int = HOT_ROWS,
    n_salts: int = 8,
) -> DataFrame:
    """Inner join of ``many`` with ``one``, which has one row per key and, in the column
    ``weight``, the number of rows ``many`` has under it.

    The weight tells the hot keys without counting; their rows are spread as in ``salted_join``.
    """
    keys = list(keys)
    hot = one.where(F.col(weight) >= min_rows).select(*keys)
    return _salted(one, many, keys, hot, n_salts, "inner", min_rows)


def two_stage_agg(
    df: DataFrame,
    keys: Sequence[str],
    sums: Mapping[str, Column] | None = None,
    counts: Mapping[str, Column] | None = None,
    distinct: Mapping[str, Column] | None = None,
    n_salts: int = 8,
) -> DataFrame:
    """Aggregate by key and salt first, then by key, reading ``df`` once.

    Sums and counts are added up before the shuffle by Spark itself; counting the distinct values
    of a hot key needs the salt, which is taken from the counted value, so that each value is
    counted under one salt only and the partial counts add up. With several distinct counts every
    row stands once for each of them, with one of the values.
    """
    keys = list(keys)
    sums, counts, distinct = dict(sums or {}), dict(counts or {}), dict(distinct or {})
    if not (sums or counts or distinct):
        raise ValueError("nothing to aggregate")
    plain = [F.sum(e).alias(a) for a, e in sums.items()]
    plain += [F.count(e).alias(a) for a, e in counts.items()]
    if not distinct:
        return df.groupBy(*keys).agg(*plain)
    kind = {a: df.select(e.alias(a)).schema[a].dataType for a, e in distinct.items()}
    names = list(distinct)
    turns = F.explode(F.array(*[
        F.struct(
            F.lit(i).alias("turn"),
            *[(e if a == b else F.lit(None).cast(kind[b])).alias(b) for b, e in distinct.items()],
        )
        for i, a in enumerate(names)
    ]))
    # Sums and counts are taken from the first of a row's copies.
    inputs = {**sums, **counts}
    rows = df.select(*keys, *[e.alias(f"_in_{a}") for a, e in inputs.items()], turns.alias("_t"))
    first = F.col("_t.turn") == 0
    salted = rows.withColumn("_salt", salt_of(n_salts, *[F.col(f"_t.{a}") for a in names]))
    per_salt = salted.groupBy(*keys, "_salt").agg(
        *[F.sum(F.when(first, F.col(f"_in_{a}"))).alias(a) for a in sums],
        *[F.count(F.when(first, F.col(f"_in_{a}"))).alias(a) for a in counts],
        *[F.count_distinct(F.col(f"_t.{a}")).alias(a) for a in names],
    )
    return per_salt.groupBy(*keys).agg(*[F.sum(a).alias(a) for a in (*sums, *counts, *names)])


def _all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present
