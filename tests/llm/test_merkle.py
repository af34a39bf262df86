"""The manifest and its proofs against a plain recursive tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from orderloom.llm import merkle

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, tree string, rank double, leaf int"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(doc_id, text, lang, source, n_chars):
    parts = [None if v is None else str(v) for v in (doc_id, source, lang, n_chars, text)]
    return sha("".join("-" if v is None else f"{len(v.encode())}:{v}" for v in parts))


def tree(nodes):
    """Root of the nodes, and for each of them the texts left and right of it on every level."""
    ways, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run, j = nodes[a // 16 * 16 : a // 16 * 16 + 16], a % 16
            ways[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
            at[i] = a // 16
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], ways


def brute(rows):
    by = {}
    for r in rows:
        by.setdefault(r[3], []).append(r[:5])
    names = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        by[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(*r)))
    trees = [tree([leaf(*r) for r in by[s]]) for s in names]
    root, tops = tree([t[0] for t in trees])
    out = []
    for s, (subroot, ways), top in zip(names, trees, tops, strict=True):
        for r, way in zip(by[s], ways, strict=True):
            mine = folded = leaf(*r)
            if r[0] is not None and r[1] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0:
                folded = leaf(r[0], "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1]), *r[2:])
            for a, b in way + top:
                folded = sha(a + folded + b)
            out.append((r[0], mine, subroot, root, sha("".join(a + b for a, b in way + top)), folded, folded == root))
    return out


def order(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, str(v)) for v in r))


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 0.5, 1) for r in rows], SCHEMA).repartition(5)


def planted():
    rows = [(i, f"Text {i} É", "en", "hot", i) for i in range(400)]
    rows += [(i, "A" * (i % 3), None, f"s{i % 23}", None) for i in range(400, 700)]
    rows += [(None, "No id", "en", "hot", 1), (None, None, None, None, None), (700, None, "de", None, 3), (701, "", "", "", 0)]
    rows += [(5, "Text 5 É", "en", "hot", 5)] * 40 + [(6, "Another 6", "en", "hot", 6), (702, "x" * 200_000 + "Y", "en", "lone", 1)]
    return rows


def test_all_rows(spark):
    rows = planted()
    got = merkle.verify(frame(spark, rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert order(tuple(r) for r in got.collect()) == order(brute(rows))


@pytest.mark.parametrize("n", [1, 2, 16, 17, 257])
def test_sizes_of_one_source(spark, n):
    rows = [(i * 7, f"T{i}", "en", "only", i) for i in range(n)]
    assert order(tuple(r) for r in merkle.verify(frame(spark, rows)).collect()) == order(brute(rows))


def test_many_lone_sources(spark):
    rows = [(i, "Ab", "en", f"s{i:03d}", 2) for i in range(40)]
    assert order(tuple(r) for r in merkle.verify(frame(spark, rows)).collect()) == order(brute(rows))


def test_empty(spark):
    got = merkle.verify(frame(spark, planted()).limit(0))
    assert got.count() == 0 and got.columns[-1] == "verified"


def test_requested_leaves_only(spark):
    """A few requests open only the records on their ways, and get the same proofs as when all are asked for."""
    manifest = merkle.commit(frame(spark, planted()))
    some = manifest.members.filter(F.col("doc_id").isin(3, 399, 555, 702, 700))
    text = F.concat_ws("|", F.flatten(F.transform("way", lambda s: F.array(s["left"], s["right"]))))
    row = lambda df: sorted(map(tuple, df.select("tree", "rank", "leaf", "subroot", text).collect()))
    whole = merkle.proofs(manifest).filter(F.col("doc_id").isin(3, 399, 555, 702, 700))
    assert row(merkle.proofs(manifest, some)) == row(whole) and len(row(whole)) == 5
    assert merkle.open_runs(manifest, some).count() == 5
    # Records are stored by digest: one of 16 equal leaves is opened like any other.
    assert merkle.open_runs(manifest).count() < manifest.members.count()


def test_forged_sibling_does_not_fold_to_the_root(spark):
    manifest = merkle.commit(frame(spark, planted()))
    way = F.transform("way", lambda s: F.struct(s["left"], F.concat(s["right"], F.lit("0")).alias("right")))
    found = merkle.proofs(manifest).select(merkle.fold(F.col("leaf"), F.col("way")).alias("good"), merkle.fold(F.col("leaf"), way).alias("bad"))
    assert found.filter((F.col("good") != manifest.root) | (F.col("bad") == manifest.root)).count() == 0


def test_ways_are_never_broadcast(spark):
    """A frontier grows with the table, but Spark's estimate of it does not: its joins must not go through the driver."""
    rows = [(i, f"T{i}", "en", f"s{i % 3}", i) for i in range(3000)]
    manifest = merkle.commit(frame(spark, rows))
    met = merkle.proofs(manifest)
    assert len(met.collect()) == len(rows)
    plan = met._jdf.queryExecution().executedPlan().toString()
    joins = [line for line in plan.split("Initial Plan")[0].splitlines() if "BroadcastHashJoin" in line]
    # What is left looks the sources up, one row each.
    assert joins and all("source" in line for line in joins), joins
