"""Cleaning, scalar functions and deduplication on hand-written rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.functions import numeric, orders, temporal, text
from orderloom.operators import clean, dedup, project, ranks


def one(spark, expr):
    return spark.range(1).select(expr.alias("v")).first()["v"]


def test_strip_removes_every_kind_of_whitespace(spark):
    data = [(" Mobile ",), ("fr\t",), ("  x\n",), (None,), ("a b",), ("   ",)]
    df = spark.createDataFrame(data, "s string").select(text.strip(F.col("s")).alias("v"))
    assert [r["v"] for r in df.collect()] == [s.strip() if s is not None else None for (s,) in data]


def test_normalize_text_cases(spark):
    df = spark.createDataFrame(
        [(" E-1 ", "fr\t", " Mobile ", None)], "event_id string, customer_country string, order_device string, order_channel string"
    )
    assert tuple(clean.normalize_text(df).first()) == ("E-1", "FR", "mobile", None)


@pytest.mark.parametrize(
    "value, expected",
    [
        ("2026-01-08T17:59:18.973023Z", dt.datetime(2026, 1, 8, 17, 59, 18, 973023)),
        ("zzz", None),
        ("1767895158973", dt.datetime(2026, 1, 8, 17, 59, 18, 973000)),
        (None, None),
    ],
)
def test_parse_time_or_epoch(spark, value, expected):
    got = one(spark, temporal.parse_time_or_epoch(F.lit(value).cast("string")).cast("string"))
    assert got == (None if expected is None else expected.isoformat(sep=" ").rstrip("0"))


def test_parse_time_refuses_epoch(spark):
    assert one(spark, temporal.parse_time(F.lit("1767895158973"))) is None


def test_event_time_falls_back_to_broker_then_now(spark):
    broker = F.lit("2026-01-01 00:00:00").cast("timestamp")
    got = one(spark, temporal.event_time_with_fallback(F.lit("zzz"), broker).cast("string"))
    assert got == "2026-01-01 00:00:00"
    missing = F.lit(None).cast("timestamp")
    assert one(spark, temporal.event_time_with_fallback(F.lit("zzz"), missing)) is not None
    assert one(spark, temporal.event_time_with_fallback(F.lit("zzz"), missing, now=False)) is None


@pytest.mark.parametrize("n, batch, stream", [(2, 5.0, 6.0), (0, None, 12.0), (-1, None, 12.0), (None, None, 12.0)])
def test_unit_prices(spark, n, batch, stream):
    count = F.lit(n).cast("bigint")
    assert one(spark, orders.price_per_item(F.lit(10.0), count)) == batch
    assert one(spark, orders.price_per_item_stream(F.lit(12.0), count)) == stream


def test_inconsistency_needs_more_than_the_tolerance(spark):
    assert one(spark, orders.is_inconsistent(F.lit(0.0))) is False
    assert one(spark, orders.is_inconsistent(F.lit(0.25))) is True
    assert one(spark, orders.is_inconsistent(F.lit(-0.25))) is True


def test_order_rules(spark):
    assert one(spark, orders.shipping_rule(F.lit(80.0), F.lit(5.0))) == 5.0
    assert one(spark, orders.shipping_rule(F.lit(80.01), F.lit(5.0))) == 0.0
    assert one(spark, orders.total_rule(F.lit(10.0), F.lit(2.0), F.lit(30.0))) == 1.0
    assert one(spark, orders.total_rule(F.lit(10.005), F.lit(0.0), F.lit(0.0))) == 10.01


def test_rule_score(spark):
    args = [F.lit("fashion"), F.lit("mobile"), F.lit(20.0), F.lit("email")]
    assert one(spark, orders.rule_return_score(*args)) == pytest.approx(0.18 + 0.15 + 0.03 + 0.08 - 0.02)
    nothing = [F.lit(None).cast("string"), F.lit(None).cast("string"), F.lit(None).cast("double"), F.lit(None).cast("string")]
    assert one(spark, orders.rule_return_score(*nothing)) == 0.18


def test_clip_and_number_keep_null(spark):
    assert one(spark, numeric.clip(F.lit(None).cast("double"), F.lit(0.0), F.lit(1.0))) is None
    assert one(spark, numeric.clip(F.lit(5.0), F.lit(0.0), F.lit(1.0))) == 1.0
    assert one(spark, numeric.to_number(F.lit("x1"))) is None
    assert one(spark, numeric.to_number(F.lit("NaN"))) is None
    assert one(spark, text.padded_id("CUST", 4, F.lit(42))) == "CUST-0042"


def test_flatten_names_and_order(spark):
    df = spark.createDataFrame(
        [(1, ("a", ("x", 2)), 3)], "id int, customer struct<name:string, deep:struct<p:string,q:int>>, z int"
    )
    flat = clean.flatten(df)
    assert flat.columns == ["id", "z", "customer_name", "customer_deep_p", "customer_deep_q"]
    assert tuple(flat.first()) == (1, 3, "a", "x", 2)


def test_raw_schema_flattens_to_event_columns(spark):
    flat = clean.flatten(spark.createDataFrame([], schemas.RAW))
    assert flat.columns == [f.name for f in schemas.EVENT.fields]


def test_typed_turns_bad_values_to_null(spark):
    df = spark.createDataFrame([("x", "zzz", "no")], "order_n_items string, event_time string, order_is_returned string")
    assert tuple(clean.typed(df).first()) == (None, None, False)
    good = spark.createDataFrame([("3", "2026-01-01T00:00:00Z", "1")], df.schema)
    assert clean.typed(good).first()["order_is_returned"] is True


def _dated(spark):
    return spark.createDataFrame(
        [
            ("a", "2026-01-01", 1), ("a", "2026-01-02", 2),
            ("b", "2026-01-01", 5), ("b", "2026-01-01", 4),
            ("c", None, 7), ("c", "2026-01-01", 8),
            ("d", None, 9), (None, "2026-01-01", 10), (None, "2026-01-03", 11),
        ],
        "k string, t string, n int",
    ).withColumn("t", F.to_timestamp("t"))


def test_latest_per_key(spark, as_rows):
    got = as_rows(dedup.latest_per_key(_dated(spark), "k", "t", ["n"]).select("k", "n"))
    assert got == [(None, 11), ("a", 2), ("b", 4), ("c", 8), ("d", 9)]


def test_keep_last_prefers_missing_time(spark, as_rows):
    got = as_rows(dedup.keep_last_per_key(_dated(spark), "k", "t", ["n"]).select("k", "n"))
    assert got == [(None, 11), ("a", 2), ("b", 5), ("c", 7), ("d", 9)]


def test_latest_is_limited_before_the_shuffle(spark):
    plan = dedup.latest_per_key(_dated(spark), "k", "t", ["n"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_distinct_rows_null_equals_null(spark):
    df = spark.createDataFrame([(1, None), (1, None), (1, "x")], "a int, b string")
    assert dedup.distinct_rows(df).count() == 2


@pytest.mark.parametrize("items, expected", [([2, 3, None], 2), ([3, 4, None], 4), ([1, 2, 9, None], 2)])
def test_impute_rounds_the_median_half_to_even(spark, items, expected):
    fields = "event_id string, customer_country string, order_device string, order_channel string, order_main_category string, order_n_items long, order_basket_value double, order_shipping_fee double, order_discount double"
    data = [(str(i), None, "m" if i else None, "b" if i % 2 else "a", "c", n, float(i) if i else None, None, None) for i, n in enumerate(items)]
    got = {r["event_id"]: r for r in clean.impute(spark.createDataFrame(data, fields)).collect()}
    assert got[str(len(items) - 1)]["order_n_items"] == expected
    assert got["0"]["order_device"] == "m" and got["0"]["customer_country"] == "UN"
    assert got["0"]["order_shipping_fee"] == 0.0 and got["0"]["order_discount"] == 0.0
    values = sorted(float(i) for i in range(1, len(items)))
    middle = (values[(len(values) - 1) // 2] + values[len(values) // 2]) / 2
    assert got["0"]["order_basket_value"] == middle


def test_mode_ties_take_the_smallest_and_skip_null(spark, as_rows):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 2), (None, 2), ("a", 1), ("b", 3)], "s string, n int")
    assert as_rows(ranks.modes(df, ["s", "n"])) == [("n", "2", 3), ("s", "a", 2)]


def test_align_union_and_features(spark, as_rows):
    old = spark.createDataFrame([(1, "x")], "id int, b string")
    new = spark.createDataFrame([(2, 0.5)], "id int, a double")
    union = project.align_union(old, new)
    assert union.columns == ["a", "b", "id"]
    assert as_rows(union) == [(None, "x", 1), (0.5, None, 2)]
    assert tuple(project.align_features(new, ["z", "a"]).first()) == (0.0, 0.5)


def test_required_columns_are_named(spark):
    with pytest.raises(KeyError, match="order_id"):
        project.require_columns(spark.range(1), ["id", "order_id"])


def test_evolve_and_report(spark, as_rows):
    df = spark.createDataFrame([(1, "2", None), (2, "x", 5)], "id int, n string, gone int")
    out = project.evolve(df, add={"at": F.lit("now")}, retype={"n": "int"}, rename={"id": "key"}, drop=["gone"])
    assert as_rows(out) == [(1, 2, "now"), (2, None, "now")]
    assert as_rows(project.column_report(df)) == [(0, "id", "int", 2), (1, "n", "string", 2), (2, "gone", "int", 1)]
    assert project.columns_by_type(df, "number") == ["id", "gone"]
