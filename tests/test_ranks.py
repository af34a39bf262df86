"""Order statistics against brute force."""

import math
import random
import statistics

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from orderloom.operators import ranks


def brute(values, p):
    v = sorted(values)
    at = p * (len(v) - 1)
    lo, hi, t = v[math.floor(at)], v[math.ceil(at)], at - math.floor(at)
    return hi - (hi - lo) * (1 - t) if t >= 0.5 else lo + (hi - lo) * t


def quantiles(spark, values, probs, **options):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = ranks.exact_quantiles(df, ["x"], probs, **options).collect()
    return {r["prob"]: r["value"] for r in got}


CASES = {
    "hot value": [7.0] * 500 + [float(i) for i in range(100)],
    "outliers": [1e18, -1e18] + [i / 1000 for i in range(300)],
    "cluster": [1.7e9 + i * 1e-3 for i in range(400)],
    "tiny": [1e-12 * i for i in range(50)],
    "signs": [float(i) for i in range(-120, 80)],
    "one": [3.5],
    "two": [1.0, 2.0],
    "constant": [4.0] * 10,
    "zeros": [0.0, -0.0, 0.0, 1.0],
}


@pytest.mark.parametrize("name", CASES)
def test_exact_quantiles(spark, name):
    values, probs = CASES[name], [0.0, 0.25, 0.5, 0.75, 0.9, 1.0]
    assert quantiles(spark, values, probs) == {p: brute(values, p) for p in probs}


def test_missing_values_are_ignored(spark):
    assert quantiles(spark, [None, float("nan"), 1.0, 3.0], [0.5]) == {0.5: 2.0}
    assert quantiles(spark, [None, None], [0.5]) == {}


def test_small_fanout_and_more_refinements_agree(spark):
    rng = random.Random(3)
    values = [rng.lognormvariate(3, 2) for _ in range(800)]
    expected = {p: brute(values, p) for p in (0.1, 0.5, 0.99)}
    assert quantiles(spark, values, expected, refinements=0) == expected
    assert quantiles(spark, values, expected, refinements=3, fanout=4) == expected


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(allow_nan=False, allow_infinity=False, width=32), min_size=1, max_size=60))
def test_random_values(spark, values):
    probs = [0.25, 0.5, 0.75]
    assert quantiles(spark, values, probs) == {p: brute(values, p) for p in probs}


def test_groups_and_columns(spark):
    rng = random.Random(5)
    data = [(rng.choice(["a", "b", None]), rng.random(), float(rng.randint(0, 9))) for _ in range(400)]
    df = spark.createDataFrame(data, "g string, x double, y double")
    got = ranks.quantiles_wide(df, ["x", "y"], {"q": 0.3}, by=["g"]).collect()
    for r in got:
        i = 1 if r["column"] == "x" else 2
        assert r["q"] == brute([d[i] for d in data if d[0] == r["g"]], 0.3)
    assert len(got) == 6


def test_medians(spark):
    df = spark.createDataFrame([(1.0, 10), (2.0, None), (10.0, 3), (3.0, 4)], "x double, y int")
    row = ranks.medians_row(df, ["x", "y"]).first()
    assert row["x"] == statistics.median([1, 2, 10, 3]) and row["y"] == 4.0


@pytest.mark.parametrize("descending", [False, True])
def test_running_totals(spark, descending):
    rng = random.Random(11)
    values = sorted({rng.choice([rng.random(), 1e6 * rng.random(), 0.5 + 1e-9 * rng.random()]) for _ in range(500)})
    df = spark.createDataFrame([(v, i % 7, 1) for i, v in enumerate(values)], "x double, a long, b long")
    got = {r["x"]: r for r in ranks.running_totals(df, "x", ["a", "b"], descending, coarse=8, fine=4).collect()}
    ordered = list(enumerate(values))
    total_a = total_b = 0
    for i, v in reversed(ordered) if descending else ordered:
        total_a, total_b = total_a + i % 7, total_b + 1
        assert (got[v]["upto_a"], got[v]["upto_b"]) == (total_a, total_b)
        assert got[v]["all_b"] == len(values)


def test_running_totals_partitioning_does_not_matter(spark, as_rows):
    df = spark.range(200).select((F.col("id") * 1.5).alias("x"), F.lit(1).cast("long").alias("n"))
    a = as_rows(ranks.running_totals(df.repartition(1), "x", ["n"]))
    assert a == as_rows(ranks.running_totals(df.repartition(7), "x", ["n"]))
