"""Tolerant numbers, clipping, and exact money sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_number(c: Column) -> Column:
    """Text to double; unreadable values and NaN become NULL."""
    return nan_to_null(c.try_cast("double"))


def nan_to_null(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def clip(c: Column, low: Column, high: Column) -> Column:
    """Limit to [low, high]; a NULL input stays NULL (least/greatest skip NULLs)."""
    return F.when(c.isNotNull(), F.greatest(F.least(c, high), low))


def money(c: Column, scale: int = 4) -> Column:
    """Exact decimal view of an amount, so sums do not depend on row order."""
    return c.cast(f"decimal(20,{scale})")


def money_sum(c: Column, scale: int = 4) -> Column:
    """Order-independent total of an amount column, as double."""
    return F.sum(money(c, scale)).cast("double")
