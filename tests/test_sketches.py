"""Sketches of days against exact distinct counts, merged and added to."""

import pathlib

from pyspark.sql import functions as F

from orderloom.operators import profile, sketches

COLUMNS = ["user", "kind", "empty"]


def rows(spark, low, high):
    n = F.col("id")
    return spark.range(low, high).select(
        F.timestamp_seconds(n * 60).alias("event_time"),
        F.when(n % 10 > 0, F.concat(F.lit("u"), (n * 7919) % 5000)).alias("user"),
        (n % 5).alias("kind"),
        F.lit(None).cast("string").alias("empty"),
    )


def near(estimate, exact):
    return abs(estimate - exact) <= 4 * sketches.STANDARD_ERROR * exact


def test_merged_days_are_within_the_error(spark):
    df = rows(spark, 0, 60_000)
    exact = {r["column"]: r for r in profile.distinct_profile(df, COLUMNS).collect()}
    daily = sketches.daily(df, COLUMNS)
    assert daily.count() == 3 * 42
    for r in sketches.merged(daily).collect():
        assert near(r.n_distinct, exact[r["column"]].n_distinct) and r.n_null == exact[r["column"]].n_null and r.n == 60_000
    by_month = {(r.month, r["column"]): r.n_distinct for r in sketches.merged(daily, [F.month("day").alias("month")]).collect()}
    for month in (1, 2):
        assert near(by_month[month, "user"], df.where(F.month("event_time") == month).agg(F.countDistinct("user")).first()[0])
    assert sketches.merged(sketches.daily(df.limit(0), COLUMNS)).count() == 0


def test_batches_add_up_and_leave_other_days_alone(spark, tmp_path):
    root = str(tmp_path)
    assert sketches.stored(spark, root) is None
    sketches.add(spark, root, rows(spark, 0, 20_000), COLUMNS)
    before = {str(p): p.read_bytes() for p in pathlib.Path(root).rglob("*.parquet")}
    late = rows(spark, 19_000, 21_000).unionByName(rows(spark, 0, 1).withColumn("event_time", F.lit(None).cast("timestamp")))
    sketches.add(spark, root, late, COLUMNS)  # a thousand rows come twice
    after = {str(p): p.read_bytes() for p in pathlib.Path(root).rglob("*.parquet")}
    assert before.items() <= after.items()
    table = sketches.stored(spark, root)
    assert table.where("day IS NULL").count() == 3 and table.count() == 3 * (15 + 1)
    got = {r["column"]: r for r in sketches.merged(table).collect()}
    exact = rows(spark, 0, 21_000).agg(F.countDistinct("user")).first()[0]
    assert near(got["user"].n_distinct, exact) and got["user"].n == 22_001
    whole = {(r.day, r["column"]): r.e for r in sketches.daily(rows(spark, 0, 21_000), COLUMNS).select("day", "column", F.hll_sketch_estimate("sketch").alias("e")).collect()}
    mine = {(r.day, r["column"]): r.e for r in table.where("day IS NOT NULL").select("day", "column", F.hll_sketch_estimate("sketch").alias("e")).collect()}
    assert mine.keys() == whole.keys() and all(near(mine[k], v) for k, v in whole.items())
