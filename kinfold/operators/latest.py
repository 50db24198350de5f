"""The newest version of each record."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.functions import orderable_columns


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_by: str | Column = "event_time",
    tie_breakers: Sequence[str | Column] | None = None,
    drop_deletes: bool = False,
    op_column: str = "op_type",
) -> DataFrame:
    """Keep one row per key: the one with the greatest ``order_by``; NULL times lose.

    Equal times are decided by ``tie_breakers``, greatest first; by default by every other
    column, so the winner never depends on task order. NULL keys form one group. A DELETE is a
    version like any other unless ``drop_deletes`` asks to remove keys whose newest version is one.

    The ``row_number() = 1`` form lets Spark keep one row per key and task before the shuffle, so
    a key with very many versions costs no more to shuffle than any other.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if tie_breakers is None:
        used = {*keys, order_by} if isinstance(order_by, str) else set(keys)
        tie_breakers = [c for c in orderable_columns(df) if c not in used]
    first = [F.col(c) if isinstance(c, str) else c for c in [order_by, *tie_breakers]]
    newest_first = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in first])
    out = df.withColumn("_rank", F.row_number().over(newest_first)).where("_rank = 1").drop("_rank")
    if drop_deletes:
        out = out.where(~F.col(op_column).eqNullSafe("DELETE"))
    return out
