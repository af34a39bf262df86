"""Bit-sliced weights and the draw against plain sums over features."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from orderloom.llm import importance

SCHEMA = "doc_id bigint, text string, score string, bucket int, rank int"


def words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def buckets(text):
    w = words(text)
    return [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:], strict=False)]]


def brute(rows, target):
    s = Counter(b for r in rows for b in buckets(r[1]))
    t = Counter(b for x in target for b in buckets(x))
    s_all, t_all = sum(s.values()) + 10000, sum(t.values()) + 10000
    gain = [math.floor(1000 * math.log((t[b] + 1) * s_all / ((s[b] + 1) * t_all))) for b in range(10000)]
    out = []
    for doc_id, text in rows:
        found = buckets(text)
        weight = sum(gain[b] for b in found) // len(found) if found else 0
        h = int(hashlib.sha256(f"7:{'-' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        noise = math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([doc_id, len(found), weight, weight + noise, None])
    enough = sorted((o for o in out if o[1] >= 39), key=lambda o: (-o[3], o[0] is None, o[0] or 0, o[2], o[1]))
    for place, o in enumerate(enough[: 25 * len(enough) // 100], 1):
        o[4] = place
    return order(tuple(o) for o in out)


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def planted():
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdeÄéß0") for _ in range(rng.randint(1, 9))) for _ in range(300)]
    prose = lambda n: rng.choice([" ", "-", "\n"]).join(rng.choice(vocabulary) for _ in range(n))
    rows = [(i, prose(rng.randint(1, 80))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "!! --"), (None, prose(30)), (3, rows[3][1]), (3, prose(40)), (203, "Same Word " * 3000)]
    rows += [(204, prose(20_000)), (205, " ".join(["edge"] * 20)), (206, " ".join(["edge"] * 19)), (207, "nul\0byte " * 30)]
    return rows, [prose(50) for _ in range(6)] + [None, "", rows[5][1]]


def test_against_plain_sums(spark):
    rows, target = planted()
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA).repartition(4)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    got = importance.resample(docs, bench)
    assert dict(got.dtypes) == {c: "bigint" for c in ("doc_id", "n_features", "weight", "score", "rank")}
    assert order(tuple(r) for r in got.collect()) == brute(rows, target)


def test_empty_tables(spark):
    rows, target = planted()
    docs = spark.createDataFrame([(*r, "x", 1, 2) for r in rows[:30]], SCHEMA)
    bench = spark.createDataFrame([(t,) for t in target], "text string")
    assert order(tuple(r) for r in importance.resample(docs, bench.limit(0)).collect()) == brute(rows[:30], [])
    assert importance.resample(docs.limit(0), bench).count() == 0


def test_planes_give_exact_sums():
    rng = np.random.default_rng(1)
    gain = rng.integers(-20_000, 20_000, importance.BUCKETS)
    gain[:3] = 0, 1, -1
    owner = np.sort(rng.integers(0, 3000, 60_000))
    found = rng.integers(0, 400, 60_000)
    want = np.bincount(owner, gain[found].astype(float), 3000).astype(np.int64)
    assert (importance.total_gains(found, owner, 3000, importance.gain_planes(gain)) == want).all()
    # One bucket with a count of many bits.
    many = np.zeros(1_000_003, np.int64) + 9
    assert importance.total_gains(many, many * 0, 1, importance.gain_planes(gain))[0] == 1_000_003 * gain[9]


def test_features_of_a_batch_do_not_cross_texts():
    got, owner = importance.features(pa.array(["a b", None, "", "b"]))
    assert sorted(zip(owner.tolist(), got.tolist(), strict=True)) == sorted([(0, b) for b in buckets("a b")] + [(3, b) for b in buckets("b")])
