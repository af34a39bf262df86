"""Operators against brute force on small fixtures: nulls, empty and long texts, repeated rows, clashing columns, empty tables."""

import hashlib
import math
import random
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pytest
from pyspark.sql import functions as F

from orderloom.llm import catalog, decontam, jaccard, lang_id, licenses, mixing, pii, secrets, suffix_dedup, warc
from orderloom.session import shared_dir

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, score double, kind int"
RNG = random.Random(5)
VOCABULARY = ["".join(RNG.choice("abcdefghiklmnoprstu") for _ in range(RNG.randint(2, 7))) for _ in range(400)]


def prose(n, rng=RNG):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


BASE = [prose(60) for _ in range(12)]
PASSAGE = prose(25)
TOKEN = "1eb9c654e721b4f812088970e66a6345cee33dd6"
TEXTS = [
    *BASE,
    BASE[0],
    BASE[1].upper() + " !!",
    " ".join([*BASE[2].split()[:-1], "changed"]),
    BASE[3] + " " + PASSAGE,
    PASSAGE + " é😀 " + BASE[4][:90],
    "mail a@b.co_x@y.org +1 (743) 555-3824 1.2.3.4.5.6.7.256 8.8.8.8 4111 1111 1111 1111 999-12",
    f'é😀 token = "{TOKEN}" password: abc secret=abcdefg AKIA{"A1" * 10} x AKIA12',
    f"id AKIA{'B2' * 8} key {'aB3/' * 10} at https://host.example/path",
    "a" * 3000,
    "",
    None,
    "ok",
    prose(4000),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), "k", 0.0, 1) for i, t in enumerate(TEXTS)]
    rows += [(None, BASE[5], None, None, None, "k", 0.0, 1), (3, TEXTS[3], "en", "s0", 1, "k", 0.0, 1)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def held(df):
    return [r for r in df.collect()]


def sha(parts):
    return hashlib.sha256(",".join(parts).encode()).hexdigest()


def luhn(d):
    return sum((x * 2 - 9 if x > 4 else x * 2) if i % 2 else x for i, x in enumerate(map(int, reversed(d)))) % 10 == 0


def pii_base(t):
    digits = lambda m: re.sub("[^0-9]", "", m[0])
    kinds = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(x) <= 255 for x in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 16 <= len(digits(m)) <= 19 and luhn(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 8 <= len(digits(m)) <= 15),
    ]
    return [f"{k}:{m.start()}:{m.end()}" for k, p, ok in kinds for m in re.finditer(p, t or "") if ok(m)]


def secret_base(t):
    kinds = [
        ("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", lambda m: len(m[2]) >= 6),
        ("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
        ("hex", r"[0-9a-f]+", lambda m: len(m[0]) >= 24),
    ]
    found = [(m.start(), n, m.end(), k) for n, (k, p, ok) in enumerate(kinds) for m in re.finditer(p, t or "") if ok(m)]
    return [f"{k}:{s}:{e}" for s, _, e, k in sorted(found)]


def test_pii_base_spans(docs):
    text = {i: t for i, t in enumerate(TEXTS)} | {None: BASE[5]}
    got = held(pii.digest(docs))
    assert len(got) == docs.count()
    assert all(r.base_sha256 == sha(pii_base(text[r.doc_id])) for r in got)
    assert all(set(pii_base(text[r.doc_id])) <= set(r.spans.split(",") if r.spans else []) for r in got)
    assert pii.digest(docs.limit(0)).count() == 0


def test_pii_em_learns_reliability():
    patterns = [((1, 1, 0), 90), ((-1, -1, 0), 60), ((1, -1, 0), 5)]
    model = pii.expectation_maximisation(patterns)
    assert model.posterior((1, 1, 0)) > 0.9 > 0.1 > model.posterior((-1, -1, 0))


def test_secrets(docs):
    text = {i: t for i, t in enumerate(TEXTS)} | {None: BASE[5]}
    got = held(secrets.digest(docs))
    assert len(got) == docs.count()
    assert all(r.base_sha256 == sha(secret_base(text[r.doc_id])) for r in got)
    linked = next(r for r in got if r.doc_id == TEXTS.index(text[19]))
    assert "weak_secret" in linked.spans and "endpoint" in linked.spans
    alone = docs.sparkSession.createDataFrame([(1, "key " + "aB3/" * 10, "en", "s", 1, "", 0.0, 1)], SCHEMA)
    assert secrets.digest(alone).first().spans == ""
    far = docs.sparkSession.createDataFrame([(1, f"AKIA{'B2' * 8} " + "x " * 400 + "aB3/" * 10, "en", "s", 1, "", 0.0, 1)], SCHEMA)
    assert "weak_secret" not in secrets.digest(far).first().spans
    red = secrets.redact(docs)
    assert red.columns == docs.columns and red.count() == docs.count()
    assert not red.filter(F.col("text").contains(TOKEN)).count()
    assert red.filter("doc_id = 0").first().text == BASE[0]
    assert secrets.digest(docs.limit(0)).count() == 0


def test_mixing(docs):
    got = held(mixing.digest(docs, block_words=64))
    assert len(got) == docs.count() and sorted(map(tuple, got), key=str) == sorted(map(tuple, mixing.digest(docs, block_words=64).collect()), key=str)
    size = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sum(r["size"] for r in got) == sum(map(size, TEXTS)) + size(BASE[5]) + size(TEXTS[3])
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert sum(t for _, t in by) == pytest.approx(1.5 * sum(s for s, _ in by))
    assert all(abs(sum(v) - t) <= 1 and t <= 2 * s for (s, t), v in by.items())
    assert mixing.digest(docs.limit(0)).count() == 0


def test_wide_buckets_are_pruned_by_the_posterior(spark):
    """2,100 members of one bucket: what hangs together is what all pairs' comparison says, nothing more."""
    rng = np.random.default_rng(4)
    floor = jaccard.least_matches(jaccard.THRESHOLD, jaccard.TOLERANCE)
    centres = rng.integers(0, 256, (40, jaccard.HASHES), dtype=np.uint8)
    low = centres[np.r_[np.zeros(900, int), rng.integers(1, 40, 1200)]]
    low = np.where(rng.random(low.shape) < 0.18, rng.integers(0, 256, low.shape, dtype=np.uint8), low)
    low = np.concatenate([low, rng.integers(0, 256, (100, jaccard.HASHES), dtype=np.uint8)])
    rows = [(i, 7, low[i].tobytes()) for i in rng.permutation(len(low)).tolist()] + [(i, 8, low[0].tobytes()) for i in range(5000, 5600)]
    found = jaccard.wide_edges(spark.createDataFrame(rows, "rep bigint, bucket bigint, low binary").repartition(5), floor)
    got = {(r.a, r.b) for r in found.collect()}
    linked = jaccard.surviving(low, floor)

    def groups(edges, n):
        root = list(range(n))

        def top(i):
            while root[i] != i:
                i = root[i]
            return i

        for a, b in edges:
            root[top(a)] = top(b)
        tops = [top(i) for i in range(n)]
        least = {}
        for i, t in enumerate(tops):
            least.setdefault(t, i)
        return [least[t] for t in tops]

    n = len(low)
    assert groups([e for e in got if e[0] < 5000], n) == groups(jaccard.forest(linked), n)
    assert len({b for a, b in got if a == 5000}) == 599  # equal signatures: a star, no pairs


def test_suffix_dedup(docs):
    unique = docs.dropDuplicates(["doc_id"])
    got = {r.doc_id: r for r in held(suffix_dedup.deduplicate(unique, part_bytes=4000))}
    seen = {}
    for i, t in enumerate(TEXTS):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 49):
            if seen.get(b[p : p + 50], i) < i:
                gone[p : p + 50] = b"\1" * 50
        for p in range(len(b) - 49):
            seen.setdefault(b[p : p + 50], i)
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for k in range(len(b)) if gone[k] and not (k and gone[k - 1]))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == (len(b), sum(gone), spans, kept)
    assert got[None].n_removed == 0
    assert suffix_dedup.deduplicate(docs.limit(0)).count() == 0


def removed_bytes(texts):
    """Of each text, in the order of ids, the bytes that a smaller id's 50-byte strings cover."""
    seen, out = {}, []
    for i, t in enumerate(texts):
        b, gone = t.encode(), set()
        for p in range(len(b) - 49):
            if seen.setdefault(b[p : p + 50], i) < i:
                gone.update(range(p, p + 50))
        out.append(len(gone))
    return out


def test_suffix_dedup_of_a_very_common_passage(spark):
    """Anchors at the ends of a passage have another suffix in each document; no group holds them all."""
    rng = random.Random(8)
    ends = [prose(4, rng) for _ in range(6)]  # some neighbourhoods repeat too
    around = lambda: rng.choice(ends) if rng.random() < 0.5 else prose(rng.randint(3, 30), rng)
    texts = [f"{around()} {PASSAGE} {around()}" for _ in range(300)] + [f"{PASSAGE} {PASSAGE}"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(3)
    for hot_rows in (20, 10_000):
        got = suffix_dedup.deduplicate(df, part_bytes=4000, hot_rows=hot_rows).collect()
        assert [n for _, n in sorted((r.doc_id, r.n_removed) for r in got)] == removed_bytes(texts)
    tables = []
    for part in range(4):
        own = [(i, t) for i, t in enumerate(texts) if i % 4 == part]
        ids, held_ = zip(*own, strict=True)
        tables.append(pa.table({"part": [part] * len(ids), "rid": ids, "doc_id": ids, "text": held_}))
    none = pa.table({"copies": pa.array([None], pa.list_(pa.int64()))})
    asked = pa.concat_tables([suffix_dedup._ask(t, none, 1) for t in tables])
    answers = suffix_dedup._answer(asked, 20)
    sizes = {}
    for part, t in enumerate(tables):
        extra = answers.filter(pc.equal(answers.column("part"), part))
        extra = extra.append_column("copies", pa.nulls(extra.num_rows, pa.list_(pa.int64())))
        for h, before in zip(*(suffix_dedup._suffixes(t, extra, 1).column(c).to_pylist() for c in ("h", "before")), strict=True):
            if before >= 0:
                sizes[h] = sizes.get(h, 0) + 1
    assert max(sizes.values()) <= 20  # 300 documents before
    # A hot suffix costs the digests of the strings that have its anchor as their own, each once a part.
    entries, suffixes = 0, 0
    for part, t in enumerate(tables):
        extra = answers.filter(pc.equal(answers.column("part"), part))
        hot = np.concatenate([np.frombuffer(x, np.uint32) for x in extra.column("hot").to_pylist()])
        for data, starts, _, _ in suffix_dedup.slices(t, set()):
            suffixes += int(np.isin(suffix_dedup.anchors(data, starts)[1].astype(np.uint32), hot).sum())
        extra = extra.append_column("copies", pa.nulls(extra.num_rows, pa.list_(pa.int64())))
        out = suffix_dedup._suffixes(t, extra, 1)
        blobs = [b for b, kind in zip(out.column("suffix").to_pylist(), out.column("before").to_pylist(), strict=True) if kind == -2]
        entries += sum(len(suffix_dedup._unpacked_strings(b)[0]) for b in blobs)
    assert 0 < entries <= 20 * suffixes


def test_parts_share_files(spark, monkeypatch):
    """More parts than files: the same result, and parts stay small."""
    monkeypatch.setattr(suffix_dedup, "MAX_FILES", 3)
    texts = [prose(30) + (" " + PASSAGE if i % 3 == 0 else "") for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = suffix_dedup.deduplicate(df, part_bytes=500, hot_rows=5).collect()
    assert [n for _, n in sorted((r.doc_id, r.n_removed) for r in got)] == removed_bytes(texts)


def test_suffix_dedup_of_repeated_ids(spark):
    """Of two rows with one id only the copy goes; the other one's text stays, and is a source for larger ids."""
    own = prose(40)
    rows = [(1, BASE[0]), (2, BASE[0]), (2, own), (3, own + " " + BASE[1])]
    got = suffix_dedup.deduplicate(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()
    size = len(own.encode())
    left = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in got)
    assert left[:3] == sorted([(1, len(BASE[0]), 0), (2, len(BASE[0]), len(BASE[0])), (2, size, 0)])
    assert left[3][2] >= size


def test_near_duplicates(docs):
    got = held(jaccard.near_duplicates(docs))
    words = lambda t: [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := words(t)) else set() for t in [*TEXTS, TEXTS[3]]]
    ids = [*range(len(TEXTS)), 3]
    links = [sum(1 for j, b in enumerate(sets) if j != i and a and len(a & b) >= 0.8 * len(a | b)) for i, a in enumerate(sets)]
    want = sorted(zip(ids, links, strict=True))
    assert sorted((r.doc_id, r.n_links) for r in got if r.doc_id is not None) == want
    assert [(r.class_id, r.n_links) for r in got if r.doc_id is None] == [(None, 0)]
    kept = jaccard.keep_one(docs)
    assert kept.columns == docs.columns and kept.filter("doc_id in (12, 13, 14)").count() == 0
    assert kept.filter("doc_id = 3").count() == 1 and kept.filter("doc_id is null").count() == 1
    assert jaccard.near_duplicates(docs.limit(0)).count() == 0


def test_one_row_of_each_text_class_with_repeated_ids(spark):
    """Rows of one id with different texts are decided each on its own."""
    near = " ".join([*BASE[0].split()[:-1], "changed"])
    rows = [(1, BASE[0]), (2, BASE[0]), (2, BASE[1]), (3, BASE[2]), (3, BASE[3]), (3, BASE[3]), (4, BASE[3]), (5, near), (5, BASE[4]), (6, None), (6, BASE[1]), (None, BASE[0])]
    kept = jaccard.keep_one(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)).collect()
    want = [(1, BASE[0]), (2, BASE[1]), (3, BASE[2]), (3, BASE[3]), (5, BASE[4]), (6, None), (None, BASE[0])]
    assert sorted(map(tuple, kept), key=str) == sorted(want, key=str)


def test_blocks_count_all_pairs(spark, monkeypatch):
    """A group larger than a block and a bucket gives the same links."""
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    base = prose(80).split()
    rows = [(i, " ".join([*base[:-1], f"end{i}"]), "en", "s", 1, "", 0.0, 1) for i in range(40)]
    got = held(jaccard.near_duplicates(spark.createDataFrame(rows, SCHEMA)))
    assert {(r.class_id, r.n_links) for r in got} == {(0, 39)}


@pytest.mark.parametrize("opened", [1 << 20, 200])
def test_retrieval_against_all_pairs(monkeypatch, opened):
    """2,000 passages against 200 items: the scores of plain BM25 over all pairs, and no other hits."""
    monkeypatch.setattr(decontam, "OPENED", opened)
    rng = random.Random(12)
    weights = [1 / (i + 1) for i in range(len(VOCABULARY))]
    text = lambda n: " ".join(rng.choices(VOCABULARY, weights, k=n))
    items = [(i, text(rng.randint(1, 120)) + ". " + text(rng.randint(1, 8)) + ".") for i in range(198)]
    items += [(198, items[3][1]), (199, "once")]
    split = [decontam.split_words(t) for _, t in items]
    df = {w: sum(w in s for s in split) for s in split for w in s}
    index = decontam.build(items, df, len(items))
    stream = []
    while len(stream) < 80_000:
        stream += text(rng.randint(20, 120)).split() if rng.random() < 0.9 else rng.choice(split)
    flat, offsets = decontam.words(pa.array([" ".join(stream), "", "once upon", items[5][1]]))
    ids = pc.fill_null(pc.index_in(flat, value_set=index.vocabulary), len(index.vocabulary)).to_numpy().astype(np.int64)
    _, start, end = decontam.passages(offsets)
    got = {}
    for p, n, score in decontam.retrieve(index, ids, start, end):
        got.setdefault((p, n), []).append(round(score, 9))
    # All pairs, segment by segment.
    parts = [(i, list(s)) for i, words in enumerate(split) for s in np.array_split(words, -(-len(words) // decontam.SEGMENT)) if len(s)]
    mean = sum(len(s) for _, s in parts) / len(parts)
    idf = {w: math.log(1 + (len(items) - n + 0.5) / (n + 0.5)) for w, n in df.items()}
    weigh = []
    for i, s in parts:
        w = {t: idf[t] * s.count(t) * 2.2 / (s.count(t) + 1.2 * (0.25 + 0.75 * len(s) / mean)) for t in set(s)}
        weigh.append((i, {t: v / sum(w.values()) for t, v in w.items()}))
    words_of = flat.to_pylist()
    want = {}
    for p, (a, b) in enumerate(zip(start, end, strict=True)):
        own = set(words_of[a:b])
        for i, w in weigh:
            score = sum(v for t, v in w.items() if t in own)
            if score >= decontam.THRESHOLD - 1e-6:
                want.setdefault((p, i), []).append(round(score, 9))
    assert len(start) >= 2000 and len(want) > 300
    assert got.keys() == want.keys()
    assert all(sorted(got[k]) == pytest.approx(sorted(want[k]), abs=1e-8) for k in want)


def test_unrelated_items_add_no_work():
    """Ten times as many items of other words open not one more run."""
    items = [(i, prose(30)) for i in range(40)]
    others = [(1000 + i, " ".join(f"other{rng}x{i}" for rng in range(30))) for i in range(400)]
    flat, offsets = decontam.words(pa.array([prose(4000)]))
    _, start, end = decontam.passages(offsets)
    met = []
    for held in (items, items + others):
        df = {}
        for _, t in held:
            for w in set(decontam.split_words(t)):
                df[w] = df.get(w, 0) + 1
        index = decontam.build(held, df, len(held))
        ids = pc.fill_null(pc.index_in(flat, value_set=index.vocabulary), len(index.vocabulary)).to_numpy().astype(np.int64)
        known = ids[ids < len(index.vocabulary)]
        met.append(int((index.run_start[known + 1] - index.run_start[known]).sum()))
    assert met[0] == met[1] > 0


def test_repeated_items_and_rows(spark):
    item = prose(20) + ". " + prose(12) + "."
    bench = spark.createDataFrame([(7, item), (7, item), (7, prose(30)), (8, "ab cd"), (None, item)], "item_id bigint, text string")
    rows = [(1, prose(50) + " " + item, "en", "s", 1, "", 0.0, 1)] * 2 + [(1, prose(50), "en", "s", 1, "", 0.0, 1), (None, item, "en", "s", 1, "", 0.0, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted(((r.doc_id, r.item_id) for r in held(decontam.contaminated(df, bench))), key=str)
    assert got == sorted([(1, 7)] * 4 + [(1, None)] * 2 + [(None, 7)] * 2 + [(None, None)], key=str)
    assert [r.doc_id for r in decontam.decontaminate(df, bench).collect()] == [1]


def test_decontamination(spark, docs):
    item = prose(20) + ". " + prose(12) + "."
    bench = spark.createDataFrame([(7, item, 0.0), (8, prose(30) + ".", 0.0), (9, None, 0.0), (10, "", 0.0)], "item_id bigint, text string, score double")
    extra = spark.createDataFrame([(100, prose(200) + " " + item.upper() + " " + prose(90), "en", "s", 1, "", 0.0, 1)], SCHEMA)
    both = docs.unionByName(extra)
    for size in (1 << 20, 100):  # one pass and several
        assert [(r.doc_id, r.item_id) for r in held(decontam.contaminated(both, bench, size))] == [(100, 7)]
    clean = decontam.decontaminate(both, bench)
    assert clean.columns == both.columns and clean.count() == docs.count()
    assert decontam.contaminated(docs.limit(0), bench).count() == 0 and decontam.contaminated(docs, bench.limit(0)).count() == 0


def test_language_id(spark):
    rng = random.Random(1)
    alphabets = {"en": ["the", "and", "ing", "tion", "th"], "de": ["sch", "ung", "ein", "lich", "ß"]}
    rows = []
    for i in range(300):
        lang = ("en", "de")[i % 2]
        text = " ".join("".join(rng.choices(alphabets[lang], k=3)) for _ in range(40))
        rows.append((i, text, lang if i % 5 else None, "hot" if i % 3 else None, 1, "", 0.0, 1))
    rows += [(900, None, "en", "hot", 1, "", 0.0, 1), (901, "", None, None, 1, "", 0.0, 1), (902, "12 34 !!", "de", None, 1, "", 0.0, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = {r.doc_id: r for r in held(lang_id.identify(df))}
    assert len(got) == 303
    assert all(got[i].lang == ("en", "de")[i % 2] and got[i].accepted for i in range(300))  # a fifth was never declared
    assert not any(got[i].accepted for i in (900, 901, 902))
    assert lang_id.keep_identified(df).count() == 300
    assert lang_id.identify(df.limit(0)).count() == 0


def test_licenses(spark):
    rows = [
        (1, "a/LICENSE", "Released under the MIT License."), (2, "a/b/x.txt", prose(50)), (3, "a/b/c/y.txt", prose(30)),
        (4, "a/b/c/COPYING", "Licensed under the Apache License, Version 2.0."), (5, "z.txt", prose(40)),
        (6, "a/k.txt", prose(100) + " Licensed under CC BY-NC 4.0. " + prose(100)), (7, None, "Released under the MIT License."), (8, "a/b/n", None),
    ]
    df = spark.createDataFrame(rows, "id bigint, path string, text string")
    got = {r.id: (r.license, r.origin, r.from_dir) for r in held(licenses.scan(df))}
    assert got == {
        1: ("MIT", "own", None), 2: ("MIT", "inherited", "a"), 3: ("Apache-2.0", "inherited", "a/b/c"), 4: ("Apache-2.0", "own", None),
        5: (None, None, None), 6: ("CC-BY-NC-4.0", "own", None), 7: ("MIT", "own", None), 8: ("MIT", "inherited", "a"),
    }
    assert licenses.scan(df.limit(0)).count() == 0


@pytest.mark.parametrize("frequent", [licenses.FREQUENT, 20])  # all weights known, and rare words joined
def test_license_notices_in_a_large_table(spark, monkeypatch, frequent):
    """Notices keep their score among words that occur once, in a table of 12,000 files."""
    monkeypatch.setattr(licenses, "FREQUENT", frequent)
    notices = [(name, t) for name, ts in licenses.TEMPLATES.items() for t in ts]
    rows = [(i, None, f"once{i}a once{i}b {t}, once{i}c once{i}d") for i, (_, t) in enumerate(notices)]
    rows += [(100, None, "x Released under the MIT rare License y"), (101, None, "once Released under the MIT and once License")]
    rows += [(1000 + i, None, prose(12)) for i in range(12_000)]
    df = spark.createDataFrame(rows, "id bigint, path string, text string").repartition(3)
    got = {r.id: (r.license, r.score) for r in held(licenses.scan(df))}
    assert len(got) == len(rows)
    assert {i: got[i][0] for i in range(len(notices))} == {i: name for i, (name, _) in enumerate(notices)}
    assert all(got[i][1] == pytest.approx(1) for i in range(len(notices)))
    assert all(got[i][0] is None for i in got if i >= 1000)
    # By hand: five words of the MIT notice and one word that one file holds.
    texts = [set(re.findall(r"\w+", t.lower())) for _, _, t in rows]
    idf = lambda w: np.log((1 + len(rows)) / (1 + sum(w in t for t in texts))) + 1
    notice = sum(idf(w) ** 2 for w in ("released", "under", "the", "mit", "license"))
    assert got[100][1] == pytest.approx(np.sqrt(notice / (notice + idf("rare") ** 2)))


def test_unidentifiable_text_in_hosts_of_all_sizes(spark):
    """One gibberish text is rejected alike in a small host and in one that owns most rows."""
    rng = random.Random(2)
    alphabets = {"en": ["the", "and", "ing", "tion", "th"], "de": ["sch", "ung", "ein", "lich", "ß"]}
    odd = ["".join(rng.choice("bqxzvkjwp") for _ in range(n)) for n in range(6, 60, 2)]
    hosts = {"hot": 3000} | {f"small{i}": 20 for i in range(len(odd))}
    rows = []
    for host, n in hosts.items():
        for i in range(n):
            lang = ("en", "de")[i % 2]
            rows.append((len(rows), " ".join("".join(rng.choices(alphabets[lang], k=3)) for _ in range(20)), lang, host))
    first = len(rows)
    rows += [(first + i, odd[i // 2], None, ("hot", f"small{i // 2}")[i % 2]) for i in range(2 * len(odd))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string")
    got = {r.doc_id: r.accepted for r in held(lang_id.identify(df))}
    assert all(got[i] for i in range(first))
    assert [got[first + 2 * i] for i in range(len(odd))] == [got[first + 2 * i + 1] for i in range(len(odd))]
    assert not got[first + 2 * len(odd) - 1]


def test_license_query_on_pages(spark, tmp_path):
    """License pages of any length pass their license down the host's directories; documents only have their own."""
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
    html = lambda t: f"<html><style>p{{}}</style><body><p>{t}</p></body></html>"
    pages = [
        (1, "https://h.example/src/license.html?x=1", html(f"{notice} {prose(150)}")), (2, "http://h.example/src/a/b/page#top", html(prose(40))),
        (3, "https://h.example/other/page", html(prose(40))), (4, "https://h.example/src/a/grant", html(notice.replace(" to any", " <b>to</b> any"))),
        (5, "https://h.example/src/page", html(prose(40))), (6, "https://h.example/other/b/long", html(f"{prose(100)} Licensed under CC BY 4.0")),
        (7, "https://h.example/other/b/x", html(prose(30))), (8, None, None),
    ]
    spark.createDataFrame(pages, "page_id bigint, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    docs = [(1, "Released under the MIT License.", "en", "s"), (2, prose(20), "en", "s"), (None, prose(20), "en", "s")]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.table, r.doc_id): (r.license, r.origin, r.from_dir) for r in catalog.op8_license_scan(spark, str(tmp_path)).collect()}
    none = (None, None, None)
    assert got == {
        ("pages", 1): ("MIT", "own", None), ("pages", 2): ("MIT", "inherited", "h.example/src/a"), ("pages", 3): none,
        ("pages", 4): ("MIT", "own", None), ("pages", 5): ("MIT", "inherited", "h.example/src"), ("pages", 6): ("CC-BY-4.0", "own", None),
        ("pages", 7): none, ("pages", 8): none, ("documents", 1): ("MIT", "own", None), ("documents", 2): none, ("documents", None): none,
    }


def test_redaction_of_very_many_parts(spark):
    """30,000 parts in one text, among other characters than ASCII, in a plan that reads no prefix again for each."""
    rng = random.Random(6)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(24)) for _ in range(50)]
    long = " é😀 ".join(rng.choice(hexes) for _ in range(30_000))
    small = f'😀 token = "{TOKEN}" and {hexes[0]}'
    rows = [(1, long), (2, small), (3, "clean é"), (4, None), (2, small)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("n_chars", F.length("text"))
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in secrets.redact(df).collect()), key=str)
    swept = " é😀 ".join(["[SECRET]"] * 30_000)
    want = [(1, swept), (2, "😀 [SECRET]\" and [SECRET]"), (2, "😀 [SECRET]\" and [SECRET]"), (3, "clean é"), (4, None)]
    assert [g[:2] for g in got] == sorted(want, key=str) and all(g[2] == (None if g[1] is None else len(g[1])) for g in got)


def test_weak_parts_that_base_parts_cover(spark):
    rng = random.Random(2)
    part = lambda kinds: (lambda s: (s, s + rng.randint(1, 40), rng.choice(kinds)))(rng.randint(0, 200))
    rows = [(i, [part([0, 1, 2]) for _ in range(rng.randint(0, 12))], [part([3, 4]) for _ in range(rng.randint(1, 12))]) for i in range(60)]
    shape = "array<struct<start:bigint,end:bigint,kind:int>>"
    df = spark.createDataFrame(rows, f"id int, base {shape}, weak {shape}")
    for r in df.select("id", secrets._uncovered(F.col("weak"), F.col("base")).alias("free")).collect():
        _, base, weak = rows[r.id]
        assert sorted(map(tuple, r.free)) == sorted(w for w in weak if not any(b[0] <= w[0] and b[1] >= w[1] for b in base))


def test_warc_round_trip(spark):
    long = "x" * 150
    rows = [(5, "u5", long), (2, "u2", long), (9, "u9", long), (3, "u3", "short"), (4, "u4", "short"), (6, None, None), (7, "a\r\nb", "é😀\r\n\r\n" * 40), (None, "n", long)]
    df = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    got = {r.page_id: (r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in held(warc.round_trip(df, shared_dir(spark, "warc")))}
    def record(t, ref=None):
        data = (t or "").encode()
        return len(data), hashlib.sha256(data).hexdigest(), "revisit" if ref is not None else "response", ref
    assert got == {k: record(t, 2 if k in (5, 9) else None) for k, _, t in rows}
    assert warc.round_trip(df.limit(0), shared_dir(spark, "warc")).count() == 0


def test_warc_borders_do_not_mind_outlying_keys(spark):
    """Shards stay near their size whatever the distances between keys; a key of its own may be larger, null keys come first."""
    clusters = [*range(2000), *range(10**12, 10**12 + 500), 10**18, -(10**17)]
    rows = [(k, "p", 1000) for k in clusters] + [(77, "q", 400_000), (None, "r", 10)]
    df = spark.createDataFrame(rows, "key bigint, digest string, size bigint")
    ranges, borders = warc.shard_borders(df, 100_000)
    placed = ranges.name(df).join(borders, "range").collect()
    assert len(placed) == len(rows)
    shards = {}
    for r in placed:
        shards.setdefault(r.shard, []).append(r)
    bytes_of = {n: sum(r.size + 512 for r in own) for n, own in shards.items()}
    assert all(n <= 200_000 for s, n in bytes_of.items() if not any(r.size > 100_000 for r in shards[s]))
    assert len(shards) >= (2502 * 1512) // 200_000
    order = sorted((r.key is not None, r.key or 0, r.shard) for r in placed)
    assert [o[2] for o in order] == sorted(o[2] for o in order)  # shards are ranges of the key
    again = warc.shard_borders(df.repartition(7), 100_000)[1]
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, borders.collect()))


def test_warc_rolls_files_and_repeats_bytes(spark):
    rows = [(i, f"u{i}", prose(300, random.Random(i))) for i in range(60)]
    df = spark.createDataFrame(rows, "key bigint, uri string, payload string")
    sums = []
    for parts in (2, 5):
        folder = shared_dir(spark, "warc")
        warc.write(df.repartition(parts), folder, shard_bytes=40_000, file_bytes=8_000)
        listed = spark.read.parquet(f"{folder}/manifest").orderBy("file").collect()
        sums.append([(r.file, r.sha256) for r in listed])
        back = held(warc.read(spark, folder))
        assert {r.key: bytes(r.payload).decode() for r in back} == {k: t for k, _, t in rows}
    assert sums[0] == sums[1] and len(sums[0]) > 3 and len({f[:13] for f, _ in sums[0]}) > 1


def window_marks(rows):
    """Bit x of a row: the 50 bytes that start x before its anchor also start in a smaller id at that anchor."""
    least, out = {}, []
    strings = lambda b, s: [(x, s[b - x : b - x + 50]) for x in range(35) if b >= x and len(s) - b >= 50 - x]
    for g, b, s, d in rows:
        for key in strings(b, s):
            least[g, *key] = min(least.get((g, *key), d), d)
    for g, b, s, d in rows:
        out.append(sum(1 << x for x, t in strings(b, s) if least[g, x, t] < d))
    return out


@pytest.mark.parametrize("base", [suffix_dedup._BASE, 1])  # with base 1 the hashes deceive all the time
@pytest.mark.parametrize(("n", "anchors"), [(1, 1), (90, 4), (1500, 1), (1500, 400)])
def test_suffix_sort_marks(monkeypatch, n, anchors, base):
    monkeypatch.setattr(suffix_dedup, "_BASE", base)
    rng = random.Random(n)
    rows = []
    for g in range(anchors):
        text = bytes(rng.choice(b"abc") for _ in range(84))
        for _ in range(-(-n // anchors)):
            own = bytearray(text)
            for _ in range(rng.choice([0, 1, 2])):
                own[rng.randrange(84)] = rng.choice(b"abc")
            before, after = rng.choice([34, 34, 20, 5, 0]), rng.choice([50, 50, 30, 16])
            rows.append((g, before, bytes(own[34 - before : 34 + after]), rng.randrange(n)))
    anchor, before, suffix, doc_id = zip(*rows, strict=True)
    got = suffix_dedup.marked(np.array(before), list(suffix), np.array(doc_id), np.array(anchor))
    assert got.tolist() == window_marks(rows)
