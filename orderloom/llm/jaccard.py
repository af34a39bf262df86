"""N-gram Jaccard join with Bayesian candidate pruning.

Two texts are linked if the Jaccard similarity of their sets of five-word shingles is at least 0.8.

1. One pass makes a MinHash signature of every text (``HASHES`` values) and a 128-bit fingerprint of its shingle set.
   Texts with equal sets are one class, kept as one representative with a count.
2. Representatives that agree in a whole band of ``BAND`` values are candidates.  Bands of one member are dropped by a
   counting aggregation before anything else is carried.  A pair of similarity 0.8 misses all bands with probability 5e-8.
3. Within a bucket a pair's MinHash bytes are compared ``STEP`` at a time; it is dropped once the posterior probability of reaching the
   threshold falls below ``TOLERANCE`` (uniform prior).  What is left makes a spanning forest, not a list of pairs.  In a bucket of more than
   ``BLOCK`` members all are first compared with its smallest; those that this pair keeps hang together, and only the others are compared with
   everybody, in groups of ``WIDE_BLOCK`` a side, each a task's work.
4. The forest's components are clusters.  Within each, texts are compared exactly: common shingles of all pairs are counted block
   by block (``BLOCK`` texts a side), so a large cluster is many tasks, and a task returns link counts and a spanning
   forest of true links.  Pairs are never rows, and no link between different texts is lost or capped.
5. Components of the true links are the classes of the result.

Defined cases: a text of 1 to 4 words has one shingle, all its words; null and wordless texts are linked to nothing; rows with a
null id are linked to nothing and have no class; rows that share an id are one document; equal rows are copies
of each other; the result has one row per input row; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.graph import components
from orderloom.llm.shared import bounded_batches, numbered, row_key
from orderloom.llm.words import distinct_per_text, mixed, shingles, word_hashes
from orderloom.session import materialise

WORDS = 5
THRESHOLD = 0.8
HASHES = 128
BAND = 4
STEP = 32
TOLERANCE = 1e-6
#: Texts of one side of an exact comparison; candidates of a bucket that are compared with each other at once.
BLOCK = 512
#: MinHash rows of one side of a group of comparisons within a wide bucket.
WIDE_BLOCK = 4096


def permutations(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the hash functions, from a fixed sequence."""
    numbers = mixed(np.arange(1, 2 * count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return numbers[:count] | np.uint64(1), numbers[count:]


def signatures(docs: DataFrame) -> DataFrame:
    """``(doc_id, fp, bands, low)`` of every row; the last three are null for a text without words."""
    multiply, add = permutations(HASHES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, offsets = distinct_per_text(*shingles(*word_hashes(batch.column(1)), WORDS))
            full = np.flatnonzero(np.diff(offsets) > 0)
            sig = np.empty((len(full), HASHES), np.uint32)
            if len(full):
                for j in range(HASHES):
                    h = (values * multiply[j] + add[j]) >> np.uint64(32)
                    sig[:, j] = np.minimum.reduceat(h, offsets[:-1][full])
            bands = mixed(np.ascontiguousarray(sig).view(np.uint64).reshape(len(full), -1, BAND // 2))
            bands = mixed((bands * np.uint64(3)).sum(axis=2, dtype=np.uint64) + bands[:, :, 0] + np.arange(HASHES // BAND, dtype=np.uint64))
            fps: list = [None] * batch.num_rows
            keys: list = [None] * batch.num_rows
            low: list = [None] * batch.num_rows
            for at, i in enumerate(full):
                fps[i] = hashlib.blake2b(values[offsets[i] : offsets[i + 1]], digest_size=16).digest()
                keys[i] = bands[at].view(np.int64)
                low[i] = sig[at].astype(np.uint8).tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(fps, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(low, pa.binary())],
                ["doc_id", "fp", "bands", "low"],
            )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(run, "doc_id bigint, fp binary, bands array<bigint>, low binary")


def least_matches(threshold: float, tolerance: float) -> dict[int, int]:
    """Per number of compared bytes: the fewest matches with a posterior of at least ``tolerance``.

    Bytes of different values match once in 256.  With a uniform prior the posterior that the match rate reaches
    ``c`` after m matches of n is the probability of at most m successes in n + 1 trials of rate c.
    """
    c = threshold + (1 - threshold) / 256
    out = {}
    for n in range(STEP, HASHES + 1, STEP):
        total, m = 0.0, -1
        while total < tolerance:
            m += 1
            total += math.comb(n + 1, m) * c**m * (1 - c) ** (n + 1 - m)
        out[n] = m
    return out


def compared(low: np.ndarray, a: np.ndarray, b: np.ndarray, floor: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs of rows ``(a, b)`` that the incremental comparison does not drop."""
    matches = np.zeros(len(a), np.int32)
    for end, least in floor.items():
        part = slice(end - STEP, end)
        for start in range(0, len(a), 1 << 16):
            s = slice(start, start + (1 << 16))
            matches[s] += (low[a[s], part] == low[b[s], part]).sum(axis=1, dtype=np.int32)
        alive = matches >= least
        a, b, matches = a[alive], b[alive], matches[alive]
    return a, b


def surviving(low: np.ndarray, floor: dict[int, int], side: np.ndarray | None = None) -> np.ndarray:
    """Matrix of the pairs of rows that stay; with ``side``, pairs of one side are left out."""
    n = len(low)
    a, b = np.triu_indices(n, 1) if side is None else map(np.ravel, np.meshgrid(np.flatnonzero(side), np.flatnonzero(~side)))
    a, b = compared(low, a, b, floor)
    out = np.zeros((n, n), bool)
    out[a, b] = out[b, a] = True
    return out


def forest(linked: np.ndarray) -> list[tuple[int, int]]:
    """Edges of a spanning forest of a symmetric matrix: each row to the first of its component."""
    n, seen, edges = len(linked), np.zeros(len(linked), bool), []
    for root in range(n):
        if seen[root]:
            continue
        seen[root], front = True, np.array([root])
        while len(front):
            front = np.flatnonzero(linked[front].any(axis=0) & ~seen)
            seen[front] = True
            edges += [(root, i) for i in front.tolist()]
    return edges


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Consecutive rows that agree in the first ``keys`` columns, across batches."""
    held: list[pa.RecordBatch] = []

    def key(b: pa.RecordBatch, i: int) -> tuple:
        return tuple(b.column(k)[i].as_py() for k in range(keys))

    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        new = np.zeros(batch.num_rows, bool)
        for c in columns:
            new[1:] |= c[1:] != c[:-1]
        new[0] = not held or key(held[-1], held[-1].num_rows - 1) != key(batch, 0)
        starts = np.flatnonzero(new)
        first = starts[0] if len(starts) else batch.num_rows
        if first:
            held.append(batch.slice(0, first))
        for at, start in enumerate(starts):
            if held:
                yield pa.Table.from_batches(held)
            end = starts[at + 1] if at + 1 < len(starts) else batch.num_rows
            held = [batch.slice(start, end - start)]
    if held:
        yield pa.Table.from_batches(held)


EDGE = "a bigint, b bigint"


def candidate_edges(reps: DataFrame) -> DataFrame:
    """``(a, b)``: spanning forests of the buckets' surviving pairs."""
    floor = least_matches(THRESHOLD, TOLERANCE)
    bands = reps.select("rep", F.explode("bands").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.count("*").alias("members")).filter(F.col("members") > 1)
    members = bands.join(shared, "bucket")
    tight = members.filter(F.col("members") <= BLOCK).select("bucket", "rep").join(reps.select("rep", "low"), "rep")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 1):
            low = np.stack([np.frombuffer(x, np.uint8) for x in group.column("low").to_pylist()])
            ids = group.column("rep").to_numpy()
            edges = forest(surviving(low, floor))
            if edges:
                a, b = np.array(edges).T
                yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    grouped = tight.select("bucket", "rep", "low").repartition("bucket").sortWithinPartitions("bucket")
    wide = members.filter(F.col("members") > BLOCK).select("bucket", "rep").join(reps.select("rep", "low"), "rep")
    return grouped.mapInArrow(run, EDGE).unionByName(wide_edges(materialise(wide, "jaccard-wide"), floor)).distinct()


def wide_edges(wide: DataFrame, floor: dict[int, int]) -> DataFrame:
    """``(a, b)``: the same for buckets of more than ``BLOCK`` members, from rows ``(rep, bucket, low)``."""
    # A row per wide bucket, written: where Spark broadcasts it, members of one bucket are not brought together.
    first = wide.groupBy("bucket").agg(F.min(F.struct("rep", "low")).alias("x"))
    leaders = materialise(first.select("bucket", F.col("x.rep").alias("lead"), F.col("x.low").alias("lead_low")), "jaccard-leaders")

    def with_leader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            low = np.frombuffer(b"".join([*batch.column("lead_low").to_pylist(), *batch.column("low").to_pylist()]), np.uint8).reshape(2 * n, -1)
            kept = np.zeros(n, bool)
            kept[compared(low, np.arange(n), np.arange(n) + n, floor)[0]] = True
            columns = [batch.column(c) for c in ("bucket", "lead", "rep", "low")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(kept)], ["bucket", "lead", "rep", "low", "kept"])

    met = wide.join(leaders, "bucket").select("bucket", "lead", "lead_low", "rep", "low")
    met = materialise(met.mapInArrow(with_leader, "bucket bigint, lead bigint, rep bigint, low binary, kept boolean"), "jaccard-led")
    stars = met.filter(F.col("kept") & (F.col("rep") != F.col("lead"))).select(F.col("lead").alias("a"), F.col("rep").alias("b"))
    count = lambda c: F.ceil(F.count_if(c) / WIDE_BLOCK)
    sizes = met.groupBy("bucket").agg(count(~F.col("kept")).alias("u"), count(F.col("kept")).alias("l")).filter(F.col("u") > 0)
    sizes = materialise(sizes, "jaccard-sizes")
    left = met.join(sizes, "bucket")
    own = F.pmod(F.xxhash64("rep"), F.when(F.col("kept"), F.col("l")).otherwise(F.col("u")))
    group = lambda with_led, i, j: F.struct(F.lit(with_led).alias("led"), i.alias("i"), j.alias("j"))
    upto = lambda n: F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1)
    groups = F.when(F.col("kept"), F.transform(upto("u"), lambda k: group(1, k, F.col("own")))).otherwise(
        F.concat(
            F.transform(upto("u"), lambda k: group(0, F.least(F.col("own"), k), F.greatest(F.col("own"), k))),
            F.transform(upto("l"), lambda k: group(1, F.col("own"), k)),
        )
    )
    dealt = left.withColumn("own", own).select("bucket", "rep", "low", "kept", "own", F.explode(groups).alias("g"))
    dealt = dealt.select("bucket", "g.led", "g.i", "g.j", "rep", "low", (F.col("kept") | ((F.col("g.led") == 0) & (F.col("own") != F.col("g.i")))).alias("second"))

    def across(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in runs(batches, 4):
            low = np.frombuffer(b"".join(rows.column("low").to_pylist()), np.uint8).reshape(rows.num_rows, -1)
            ids, second = rows.column("rep").to_numpy(), rows.column("second").to_numpy()
            one, two = np.flatnonzero(~second), np.flatnonzero(second)
            within = not len(two)
            if within:
                two = one
            for x in range(0, len(one), BLOCK):
                for y in range(x if within else 0, len(two), BLOCK):
                    first, other = one[x : x + BLOCK], two[y : y + BLOCK]
                    if within and x == y:
                        at, side = first, None
                    else:
                        at, side = np.concatenate([first, other]), np.arange(len(first) + len(other)) < len(first)
                    if edges := forest(surviving(low[at], floor, side)):
                        a, b = at[np.array(edges)].T
                        yield pa.RecordBatch.from_arrays([pa.array(ids[a]), pa.array(ids[b])], ["a", "b"])

    keys = ["bucket", "led", "i", "j"]
    pairs = dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(across, EDGE)
    return stars.unionByName(pairs)


def common(values: np.ndarray, owner: np.ndarray, count: int, rare: int = 8) -> np.ndarray:
    """Common shingles of all pairs of texts: a matrix of counts.

    Shingles of more than ``rare`` texts are columns of a dense product (there are few of them); the others are counted
    neighbour by neighbour in the sorted list.
    """
    out = np.zeros((count, count), np.float32)
    order = np.argsort(values, kind="stable")
    v, o = values[order], owner[order]
    new = np.ones(len(v), bool)
    new[1:] = v[1:] != v[:-1]
    group = np.cumsum(new) - 1
    size = np.bincount(group) if len(v) else np.empty(0, np.int64)
    often = size > rare
    column = np.cumsum(often) - 1
    picked = often[group]
    columns, owners = column[group[picked]], o[picked]
    for start in range(0, int(often.sum()), 4096):
        part = (columns >= start) & (columns < start + 4096)
        dense = np.zeros((count, 4096), np.float32)
        dense[owners[part], columns[part] - start] = 1
        out += dense @ dense.T
    v, o = v[~picked], o[~picked]
    flat = np.zeros(count * count, np.int64)
    for lag in range(1, rare):
        same = np.flatnonzero(v[lag:] == v[:-lag]) if len(v) > lag else np.empty(0, np.int64)
        flat += np.bincount(o[same] * count + o[same + lag], minlength=count * count)
    flat = flat.reshape(count, count)
    return out + flat + flat.T


def exact_links(docs: DataFrame, clustered: DataFrame) -> DataFrame:
    """``(a, b, links)``: forests of true links (links null), and per representative its links in a block (a = b)."""
    sizes = clustered.groupBy("cluster").agg(F.count("*").alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK)
    own = F.pmod(F.xxhash64("rep"), blocks)
    placed = clustered.join(sizes, "cluster").select("rep", "fp", "size", "cluster", own.alias("own"), F.explode(F.sequence(F.lit(0), blocks - 1)).alias("other"))
    texts = docs.select(F.col("doc_id").cast("bigint").alias("rep"), "text").join(placed, "rep")
    dealt = texts.select(
        "cluster", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "rep", "own", "fp", "size", "text"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in runs(batches, 3):
            values, offsets = distinct_per_text(*shingles(*word_hashes(group.column("text").combine_chunks()), WORDS))
            fps, reps = group.column("fp").to_pylist(), group.column("rep").to_pylist()
            # Rows that repeat an id count once, and only with the text that the fingerprint is of.
            good, seen = [], set()
            for i, (rep, fp) in enumerate(zip(reps, fps, strict=True)):
                if (rep, fp) not in seen and hashlib.blake2b(values[offsets[i] : offsets[i + 1]], digest_size=16).digest() == fp:
                    seen.add((rep, fp))
                    good.append(i)
            n = np.diff(offsets)[good]
            parts = [values[offsets[i] : offsets[i + 1]] for i in good]
            both = common(np.concatenate(parts), np.repeat(np.arange(len(good)), n), len(good)) if good else np.zeros((0, 0))
            linked = both >= THRESHOLD * (n[:, None] + n[None, :] - both) - 1e-6
            np.fill_diagonal(linked, False)
            own = group.column("own").to_numpy()[good]
            if group.column("i")[0] != group.column("j")[0]:  # pairs within a block belong to its own group
                linked &= own[:, None] != own[None, :]
            ids, size = np.array(reps)[good], group.column("size").to_numpy()[good]
            links = linked @ size if good else np.empty(0, np.int64)
            some = np.flatnonzero(links)
            a, b = np.array(forest(linked), np.int64).reshape(-1, 2).T
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([ids[a], ids[some]]), pa.int64()), pa.array(np.concatenate([ids[b], ids[some]]), pa.int64()),
                 pa.array([None] * len(a) + links[some].tolist(), pa.int64())],
                ["a", "b", "links"],
            )

    sorted_rows = dealt.repartition("cluster", "i", "j").sortWithinPartitions("cluster", "i", "j")
    return sorted_rows.mapInArrow(run, "a bigint, b bigint, links bigint")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``(doc_id, class_id, copy_of, n_links)`` per row.

    ``class_id`` is the smallest id of the row's group of linked documents, ``copy_of`` the smallest with the same shingle set,
    ``n_links`` the number of other rows it is linked to.
    """
    bounded_batches(docs.sparkSession)
    signed = materialise(signatures(docs), "jaccard-signatures")
    usable = signed.filter(F.col("doc_id").isNotNull() & F.col("fp").isNotNull())
    first = F.min(F.struct("doc_id", "bands", "low"))
    reps = materialise(
        usable.groupBy("fp").agg(first.alias("x"), F.count("*").alias("size")).select("fp", "size", F.col("x.doc_id").alias("rep"), "x.bands", "x.low"),
        "jaccard-classes",
    )
    clusters = components(candidate_edges(reps), "jaccard-clusters")
    clustered = reps.select("rep", "fp", "size").join(clusters.withColumnsRenamed({"node": "rep", "component": "cluster"}), "rep")
    links = materialise(exact_links(docs, clustered), "jaccard-links")
    joined = components(links.filter(F.col("links").isNull()), "jaccard-groups").withColumnsRenamed({"node": "rep", "component": "group"})
    counts = links.filter(F.col("links").isNotNull()).groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("far"))
    classes = reps.select("fp", "size", "rep").join(joined, "rep", "left").join(counts, "rep", "left")
    row = signed.select("doc_id", F.when(F.col("doc_id").isNotNull(), F.col("fp")).alias("fp"))
    return row.join(classes, "fp", "left").select(
        "doc_id",
        F.coalesce("group", "rep", "doc_id").alias("class_id"),
        F.coalesce("rep", "doc_id").alias("copy_of"),
        (F.coalesce("far", F.lit(0)) + F.coalesce(F.col("size") - 1, F.lit(0))).alias("n_links"),
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """One row of each group, that with the smallest id; null ids all stay.

    Rows are told apart by id and text: where ids repeat with different texts, each (id, text) takes part under a number of its own, in
    the order of ids.  Of equal ids and texts the row with the smallest other columns stays.
    """
    ids = docs.filter(F.col("doc_id").isNotNull())
    if ids.groupBy("doc_id").count().filter(F.col("count") > 1).isEmpty():
        found = near_duplicates(docs).filter(F.col("doc_id").isNotNull() & (F.col("class_id") != F.col("doc_id")))
        gone = materialise(found.select(F.col("doc_id").alias("__id")), "jaccard-result")
        return docs.join(gone, docs["doc_id"] == F.col("__id"), "left_anti")
    key = row_key(F.col("doc_id"), F.col("text"))
    keys = numbered(ids.select("doc_id", key.alias("key")).distinct(), [F.col("doc_id"), F.col("key")], "n", "jaccard-keys")
    apart = ids.select("text", key.alias("key")).join(keys.select("key", "n"), "key").groupBy("n").agg(F.min("text").alias("text"))
    apart = materialise(apart.withColumnRenamed("n", "doc_id"), "jaccard-rows")
    found = near_duplicates(apart).filter(F.col("class_id") == F.col("doc_id")).select(F.col("doc_id").alias("n"))
    stay = materialise(keys.join(found, "n").select(F.col("key").alias("__key")), "jaccard-result")
    kept = ids.select(key.alias("__key"), F.struct(*ids.columns).alias("row")).join(stay, "__key").groupBy("__key").agg(F.min("row").alias("row"))
    return kept.select("row.*").unionByName(docs.filter(F.col("doc_id").isNull()))
