"""Reproducible train/test splits.

A row's side depends only on its id and the seed, never on partitioning or on the
order rows arrive in, so lost executors and re-reads cannot move rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_HEX_DIGITS = 13
_RANGE_DIGITS = 3
_RANGE = float(16**_HEX_DIGITS)


def hex_hash(row_id: Column, seed: int) -> Column:
    """The digits of ``unit_hash``: of one length, so they sort as the number does."""
    return F.substring(F.md5(F.concat_ws(":", row_id, F.lit(str(seed)))), 1, _HEX_DIGITS)


def unit_hash(row_id: Column, seed: int) -> Column:
    """A uniform number in [0, 1) from the id: 52 bits, so exact as double."""
    return F.conv(hex_hash(row_id, seed), 16, 10).cast("double") / F.lit(_RANGE)


def random_split(df: DataFrame, row_id: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test``, true for about ``test_share`` of the rows."""
    return df.withColumn("is_test", unit_hash(F.col(row_id), seed) < F.lit(test_share))


def stratified_split(df: DataFrame, row_id: str, label: str, test_share: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``is_test`` so that every class gives exactly its rounded share.

    The cut-off of a class is the id hash at the wanted rank.  The hash is uniform, so its
    first digits are ranges of like size: rows are counted per class and range, and
    only those of the one range that holds the rank are ordered.  Ids are unique.
    """
    hashed = df.select(F.col(label).alias("__label"), hex_hash(F.col(row_id), seed).alias("__h"))
    hashed = hashed.withColumn("__range", F.substring("__h", 1, _RANGE_DIGITS))
    # At most 16 ** _RANGE_DIGITS rows per class.
    counts = hashed.groupBy("__label", "__range").agg(F.count(F.lit(1)).alias("__n"))
    total = F.sum("__n").over(Window.partitionBy("__label"))
    take = F.bround(total * F.lit(test_share)).cast("bigint")
    ranges = _holding(counts, ["__label"], "__range", F.least(take, total - 1), F.lit(0))
    # One row per class: the number of classes bounds the broadcasts.
    held = F.broadcast(ranges.withColumnsRenamed({"__label": "__of", "__range": "__in"}))
    inside = hashed.join(held, F.col("__label").eqNullSafe(F.col("__of")) & (F.col("__range") == F.col("__in")))
    hashes = inside.groupBy("__label", "__h", "__rank", "__before").agg(F.count(F.lit(1)).alias("__n"))
    cut = _holding(hashes, ["__label"], "__h", F.col("__rank"), F.col("__before"))
    limit = cut.select("__label", F.col("__h").alias("__cut"))
    marked = df.join(F.broadcast(limit), F.col(label).eqNullSafe(F.col("__label")), "left")
    test = F.coalesce(hex_hash(F.col(row_id), seed) < F.col("__cut"), F.lit(False))
    return marked.withColumn("is_test", test).drop("__label", "__cut")


def _holding(counts: DataFrame, by: list[str], order: str, rank: Column, base: Column) -> DataFrame:
    """Of each group's counted rows the one that holds the 0-based ``rank``, with the rank and the rows before it (``base`` and on)."""
    running = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = base + F.sum("__n").over(running)
    placed = counts.select(*by, order, rank.alias("__rank"), (upto - F.col("__n")).alias("__before"), upto.alias("__upto"))
    return placed.where((F.col("__before") <= F.col("__rank")) & (F.col("__rank") < F.col("__upto"))).drop("__upto")
