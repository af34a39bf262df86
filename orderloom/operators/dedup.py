"""Keyed deduplication.

Every variant is ``row_number() = 1``.  Spark pushes that limit below the shuffle
(WindowGroupLimit), so a key that owns a third of all rows reaches its reducer as
one row per map task.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: str | Iterable[str], order: Iterable[Column]) -> DataFrame:
    """The first row of every key in the given order.  NULL keys form one key."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") == 1).drop("__rn")


def latest_per_key(
    df: DataFrame, keys: str | Iterable[str], time_col: str, ties: Iterable[str] = ()
) -> DataFrame:
    """Newest row per key; rows without a time lose; equal times go to the smallest tie columns."""
    return first_per_key(df, keys, [F.col(time_col).desc_nulls_last(), *[F.col(t).asc() for t in ties]])


def keep_last_per_key(
    df: DataFrame, keys: str | Iterable[str], time_col: str, ties: Iterable[str] = ()
) -> DataFrame:
    """Ascending sort, keep the last: a row *without* a time sorts last and wins."""
    return first_per_key(df, keys, [F.col(time_col).desc_nulls_first(), *[F.col(t).desc() for t in ties]])


def last_by_sequence(df: DataFrame, keys: str | Iterable[str], sequence: Iterable[str]) -> DataFrame:
    """Last occurrence per key by an explicit arrival sequence (batch, file, line)."""
    return first_per_key(df, keys, [F.col(s).desc() for s in sequence])


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact distinct over all columns; NULL equals NULL."""
    return df.dropDuplicates()
