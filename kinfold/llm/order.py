"""Places of rows in an order over the whole table, found without a task that sees them all."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kinfold.sources.scratch import cut_lineage

#: Spark numbers the rows of a partition in the lower bits, partitions in the upper ones.
_ROW_BITS = 33


def in_order(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """``df`` range-sorted and written, with ``_part`` (its partitions ascend) and ``_row`` within it.

    ``df`` should be cheap to read, as Spark samples it first for the bounds of the ranges. The order has to tell
    rows apart, or equal ones share a partition.
    """
    at = F.monotonically_increasing_id().alias("_at")
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).select("*", at)
    return cut_lineage(placed, name).select(
        *df.columns,
        F.shiftrightunsigned("_at", _ROW_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1)).alias("_row"),
    )


def starts(ordered: DataFrame, amount: Column, groups: Sequence[str] = ()) -> DataFrame:
    """What stands before each partition of ``in_order``: ``_before``, the ``amount`` of the partitions ahead,
    for each of ``groups``. There is one row for each partition and group that meet."""
    per_part = ordered.groupBy(*groups, "_part").agg(F.sum(amount).alias("_amount"))
    ahead = Window.partitionBy(*groups).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_amount").over(ahead), F.lit(0)).cast("bigint")
    return per_part.select(*groups, "_part", before.alias("_before"))


def places(df: DataFrame, order: Sequence[Column], name: str, place: str) -> DataFrame:
    """``df`` with the place of each row in the order, from 0.

    The table of partition starts has one row for each shuffle partition, and is broadcast for that.
    """
    ordered = in_order(df, order, name)
    ahead = F.broadcast(starts(ordered, F.lit(1)))
    return ordered.join(ahead, "_part").select(*df.columns, (F.col("_before") + F.col("_row")).alias(place))
