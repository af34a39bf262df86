"""Approximate distinct counts from mergeable sketches, kept per day.

A sketch of 2 ** ``lg_k`` small registers stands for the distinct values of one column on one day.  Sketches of days are merged without reading
the days' rows again, so a report over any span costs one small row per day and column, and a new day only adds its own.  The exact counterpart is
``profile.distinct_profile``, which shuffles every distinct value.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.operators.reshape import melt
from orderloom.sources import snapshots

LG_K = 12
#: Relative standard error of one estimate: about 1.04 / sqrt(2 ** LG_K).
STANDARD_ERROR = 1.04 / 2 ** (LG_K / 2)
TABLE = "sketches"


def daily(df: DataFrame, columns: Iterable[str], time: str = "event_time", lg_k: int = LG_K) -> DataFrame:
    """``(day, column, n, n_null, sketch)``: one row per day and column; rows without a time have a NULL day.

    Registers are combined inside the tasks: what is shuffled is a sketch per day, column and task.
    """
    columns = list(columns)
    day = df.withColumn("day", F.to_date(time))
    long = melt(day, columns, ["day"], as_type="string")
    return long.groupBy("day", "column").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("value").isNull()).alias("n_null"),
        F.hll_sketch_agg("value", lg_k).alias("sketch"),
    )


def merged(sketches: DataFrame, by: Iterable[str | Column] = ()) -> DataFrame:
    """``(by..., column, n, n_null, n_distinct)`` over all days of the sketches, or per group of them (a month, a year)."""
    return sketches.groupBy(*by, "column").agg(
        F.sum("n").alias("n"),
        F.sum("n_null").alias("n_null"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("n_distinct"),
    )


def add(spark: SparkSession, root: str, df: DataFrame, columns: Iterable[str], time: str = "event_time", buckets: int = 16) -> int:
    """Merge a batch's rows into the stored sketches of their days; days that the batch does not touch keep their files.

    The stored and the new sketch of a day are united, so rows that come late, or twice, are counted once among the distinct values;
    ``n`` and ``n_null`` count rows as they came.
    """
    new = daily(df, columns, time).withColumn("id", F.concat_ws("|", F.coalesce(F.col("day").cast("string"), F.lit("-")), "column"))
    stored = snapshots.read(spark, root, TABLE)
    if stored is not None:
        old = stored.join(new.select("id"), "id", "left_semi")
        both = old.unionByName(new).groupBy("id", "day", "column")
        new = both.agg(F.sum("n").alias("n"), F.sum("n_null").alias("n_null"), F.hll_union_agg("sketch").alias("sketch"))
    return snapshots.upsert(spark, root, {TABLE: snapshots.Batch(new, "id")}, buckets)


def stored(spark: SparkSession, root: str) -> DataFrame | None:
    """The stored sketches, one row per day and column."""
    found = snapshots.read(spark, root, TABLE)
    return None if found is None else found.drop("id")
