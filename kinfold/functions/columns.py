"""Small column helpers."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def ensure_columns(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add each default column that ``df`` lacks; present columns are left alone."""
    return df.withColumns({c: e for c, e in defaults.items() if c not in df.columns})


def money_sum(amount: Column, scale: int | None = None) -> Column:
    """Sum of an amount with NULL counted as 0, as a double.

    The doubles themselves are added, so the last digits can depend on the order in which tasks
    finish. Where amounts are known to have at most ``scale`` decimals, they are added as whole units of
    ``10**-scale``, which does not; an amount that is no number counts as 0 there.
    """
    if scale is None:
        return F.sum(F.coalesce(amount, F.lit(0.0)))
    return F.sum(money_units(amount, scale)) / F.lit(float(10**scale))


def money_units(amount: Column, scale: int) -> Column:
    """An amount in whole units of ``10**-scale``; 0 for NULL and what is no number."""
    amount = F.coalesce(amount, F.lit(0.0))
    return F.coalesce(F.round(amount * F.lit(float(10**scale))).try_cast("bigint"), F.lit(0))


def exact_amount(amount: Column, scale: int | None = None) -> Column:
    """An amount as a decimal whose sums are exact: whole units where ``scale`` is known, else the amount; NULL
    where a decimal cannot hold it."""
    if scale is not None:
        return money_units(amount, scale).cast("decimal(38,18)")
    return F.coalesce(amount, F.lit(0.0)).try_cast("decimal(38,18)")


def amount_of(total: Column, scale: int | None = None) -> Column:
    """A sum of exact amounts as a double."""
    return total.cast("double") if scale is None else total.cast("bigint") / F.lit(float(10**scale))


def salt_of(n: int, *cols: Column | str) -> Column:
    """A repeatable salt in ``[0, n)``: a recomputed task gives every row the same salt again."""
    return F.pmod(F.xxhash64(*cols), F.lit(n)).cast("int")


def orderable_columns(df: DataFrame) -> list[str]:
    """Columns of plain types, which can break ties in an ordering."""
    nested = (T.MapType, T.ArrayType, T.StructType, T.VariantType)
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, nested)]
