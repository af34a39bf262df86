"""Small reshaping helpers shared by the report operators."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def melt(df: DataFrame, columns: Iterable[str], keep: Iterable[str] = (), as_type: str = "double") -> DataFrame:
    """Long form ``(keep..., column, value)``: one output row per input row and column."""
    columns, keep = list(columns), list(keep)
    typed = df.select(*keep, *[F.col(c).cast(as_type).alias(c) for c in columns])
    return typed.unpivot(keep, columns, "column", "value")


def rows_from(wide: DataFrame, rows: Iterable[Mapping[str, Column]]) -> DataFrame:
    """Turn a one-row aggregate into a report with one row per mapping."""
    structs = [F.struct(*[value.alias(name) for name, value in row.items()]) for row in rows]
    return wide.select(F.inline(F.array(*structs)))


def scalar_struct(one_row: DataFrame) -> Column:
    """A one-row frame as an uncorrelated scalar subquery returning a struct.

    Statistics reach other rows this way: Spark evaluates the subquery once and
    ships its single value, so the plan holds no join at all.
    """
    return one_row.select(F.struct(*[F.col(c) for c in one_row.columns]).alias("s")).scalar()
