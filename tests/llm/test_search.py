"""Vantage-point trees against brute force."""

import numpy as np
import pytest

from orderloom.llm import vptree

SCHEMA = "vec_id bigint, embedding array<float>, label int, rank int"


def brute(rows, k=5, every=50):
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    out = []
    for q, x in rows:
        if q % every:
            continue
        scored = sorted(
            (-(x * y).sum() / (np.sqrt((y * y).sum()) * np.sqrt((x * x).sum())), i) for i, y in rows if i != q and len(y) == len(x)
        )
        out += [(q, rank, i) for rank, (_, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("shard_rows", [10_000, 70])
def test_exact_over_shards(spark, shard_rows):
    rng = np.random.default_rng(3)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(400)]
    rows += [(1000 + i, rows[0][1]) for i in range(8)]  # ties with a query's vector
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA)
    got = vptree.search(df, shard_rows=shard_rows).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == brute(rows)


@pytest.mark.parametrize("shard_rows", [10_000, 300])
def test_copies_over_leaves_and_shards(spark, shard_rows):
    """Hundreds of copies of a query's vector: the smallest ids win, in whatever leaf they are."""
    rng = np.random.default_rng(11)
    common = rng.normal(size=(8, 64))
    rows = [(i, common[(i // 50) % 8 if i % 50 == 0 else rng.integers(8)].tolist()) for i in range(2400)]
    rows += [(10_001 + i, rng.normal(size=64).tolist()) for i in range(200)]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA)
    got = vptree.search(df, shard_rows=shard_rows).collect()
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in got) == brute(rows)


def test_copies_rounded_differently():
    """Products with copies differ in the last bit between leaves; none of the smallest ids is pruned for it."""
    for seed in range(20):
        rng = np.random.default_rng(seed)
        base = rng.normal(size=(3, 64)).astype(np.float32).astype(float)
        v = rng.normal(size=(700, 64)).astype(np.float32).astype(float)
        copy = rng.random(700) < 0.5
        v[copy] = base[rng.integers(3, size=copy.sum())]
        asked = np.flatnonzero(copy)[::9]
        for q, ids, _ in vptree.nearest_in_shard(np.arange(700), v, asked, v[asked], 5, 1.0):
            same = np.flatnonzero((v == v[q]).all(axis=1))
            assert ids.tolist() == same[same != q][:5].tolist()


def test_unusable_vectors_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    bad = [None, [], [0.0, 0.0], [1.0, None], [nan, 1.0], [inf, 1.0]]
    rows = [(0, [1.0, 0.0]), (1, [1.0, 1.0]), (None, [1.0, 0.0]), (1, [1.0, 1.0]), (2, [1.0, 0.0, 0.0])]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows] + [(50 + 50 * i, v, 0, 0) for i, v in enumerate(bad)], SCHEMA)
    got = [tuple(r) for r in vptree.search(df).collect()]
    assert [(q, r, v) for q, r, v, _ in got] == [(0, 1, 1)]
    assert got[0][3] == pytest.approx(2**-0.5, abs=1e-15)
    assert vptree.search(df.limit(0)).count() == 0


def test_relaxed_factor_keeps_most(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=8).tolist()) for i in range(600)]
    df = spark.createDataFrame([(i, v, 0, 0) for i, v in rows], SCHEMA)
    want = {(q, v) for q, _, v in brute(rows)}
    got = {(r.query_id, r.vec_id) for r in vptree.search(df, factor=1.1).collect()}
    assert len(got & want) >= 0.9 * len(want)
