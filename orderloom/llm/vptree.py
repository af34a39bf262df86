"""Nearest neighbours by vantage-point trees per shard.

Rows fall into shards by hash of their id.  Each shard builds a vantage-point tree over unit vectors (chord distance, a metric that
orders as the cosine does) and answers blocks of queries; the best of all shards win.  A subtree is left out when the
triangle inequality puts it ``factor`` times beyond a query's k-th distance so far: factor 1 is exact, larger
factors prune more.  Chords of equal vectors differ by the root of a product's rounding, so all comparisons of chords allow
``slack`` and what they leave is ordered by exact scores.  Scores are cosines of the original vectors in double precision.

Scale: the query set is dealt in blocks of ``QUERY_BLOCK`` to every shard, and (shard, block) is the unit of work, so a task
holds one shard (``SHARD_ROWS`` vectors) and one block.  A shard's vectors are sent once for each block of queries.
Tasks return k rows per query; a final window over shards * k rows per query keeps k.

Defined cases: vectors that are null, empty, zero, or hold nulls or non-finite numbers take no part; vectors meet only vectors of their length;
rows that share an id count as the query's own for that id, and of these the smallest vector is used;
ties go to the smaller id; fewer candidates than k are all returned; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.shared import bounded_batches
from orderloom.session import materialise

SHARD_ROWS = 8192
QUERY_BLOCK = 4096
LEAF = 32
RESULT = "query_id bigint, vec_id bigint, score double"


class Tree:
    """A vantage-point tree over unit vectors, as arrays of nodes; leaves hold up to ``LEAF`` rows."""

    def __init__(self, unit: np.ndarray, leaf: int = LEAF):
        self.unit, self.order = unit, np.arange(len(unit))
        # A product of unit vectors is off by at most about their length times the machine's epsilon.
        self.slack = 4 * float(np.sqrt(unit.shape[1] * np.finfo(float).eps))
        self.nodes: list[tuple] = []  # (vantage, radius, inside, outside) or (start, end)
        stack = [(0, len(unit), None, 0)]
        while stack:
            start, end, parent, side = stack.pop()
            me = len(self.nodes)
            if parent is not None:
                self.nodes[parent][2 + side] = me
            if end - start <= leaf:
                self.nodes.append([start, end])
                continue
            ids = self.order[start:end]
            # The row furthest from the first one makes a vantage point at the rim.
            far = ids[np.argmax(chord(unit[ids], unit[ids[0]]))]
            d = chord(unit[ids], unit[far])
            half = (end - start) // 2
            split = np.argpartition(d, half)
            self.order[start:end] = ids[split]
            inner, outer = d[split[:half]], d[split[half:]]
            self.nodes.append([far, (inner.min(), inner.max(), outer.min(), outer.max()), None, None])
            stack += [(start, start + half, me, 0), (start + half, end, me, 1)]

    def search(self, queries: np.ndarray, own: np.ndarray, k: int, factor: float) -> list[np.ndarray]:
        """Rows that may be among the k nearest of each unit query; ``own[i]`` is the row to leave out, or -1.

        All queries walk the tree together; a node is visited by those it was not ruled out for, nearer child first by
        majority.
        """
        n = len(queries)
        best = np.full((n, k), np.inf)
        kept: list[list[np.ndarray]] = [[] for _ in range(n)]
        stack = [(0, np.arange(n), np.zeros(n))]
        while stack:
            at, who, least = stack.pop()
            alive = least * factor <= best[who, -1] + self.slack
            who = who[alive]
            if not len(who):
                continue
            node = self.nodes[at]
            if len(node) == 2:
                ids = self.order[node[0] : node[1]]
                d = np.sqrt(np.maximum(0.0, 2 - 2 * queries[who] @ self.unit[ids].T))
                d[own[who][:, None] == ids[None, :]] = np.inf
                best[who] = np.sort(np.concatenate([best[who], d], axis=1), axis=1)[:, :k]
                near = (d <= best[who, -1][:, None] + self.slack) & np.isfinite(d)
                for row in np.flatnonzero(near.any(axis=1)):
                    kept[who[row]].append(np.stack([ids[near[row]], d[row, near[row]]]))
                continue
            d = chord(queries[who], self.unit[node[0]])
            a, b, c, e = node[1]
            bounds = [np.maximum(np.maximum(lo - d, d - hi), 0.0) for lo, hi in ((a, b), (c, e))]
            first = int((bounds[0] > bounds[1]).sum() * 2 > len(who))
            for side in (1 - first, first):
                stack.append((node[2 + side], who, bounds[side]))
        out = []
        for i, found in enumerate(kept):
            both = np.concatenate(found, axis=1) if found else np.empty((2, 0))
            out.append(both[0, both[1] <= best[i, -1] + self.slack].astype(np.int64))
        return out


def chord(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2 - 2 * rows @ one))


def cosine(rows: np.ndarray, one: np.ndarray) -> np.ndarray:
    """Cosines summed the same way for every pair, so equal vectors have equal scores."""
    return (rows * one).sum(axis=1) / (np.sqrt((rows * rows).sum(axis=1)) * np.sqrt((one * one).sum()))


def nearest_in_shard(ids, vectors, query_ids, query_vectors, k: int, factor: float) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(query id, ids, scores)`` of the k best of this shard for each query."""
    unit = vectors / np.sqrt((vectors * vectors).sum(axis=1))[:, None]
    q = query_vectors / np.sqrt((query_vectors * query_vectors).sum(axis=1))[:, None]
    place = {v: i for i, v in enumerate(ids.tolist())}
    own = np.array([place.get(v, -1) for v in query_ids.tolist()])
    for i, rows in enumerate(Tree(unit).search(q, own, k, factor)):
        score = cosine(vectors[rows], query_vectors[i])
        top = np.lexsort((ids[rows], -score))[:k]
        yield query_ids[i], ids[rows][top], score[top]


def usable(vectors: DataFrame) -> DataFrame:
    """``(vec_id, v)``: one finite, non-zero vector of doubles per id."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), v.alias("v"))
    rows = rows.filter(F.col("vec_id").isNotNull() & F.col("v").isNotNull() & F.forall("v", fine) & F.exists("v", lambda x: x != 0))
    return rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def search(vectors: DataFrame, k: int = 5, every: int = 50, factor: float = 1.0, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k nearest of every row whose id is divisible by ``every``."""
    bounded_batches(vectors.sparkSession)
    rows = materialise(usable(vectors).withColumn("dim", F.size("v")), "vp-vectors")
    shards = max(1, -(-rows.count() // shard_rows))
    queries = rows.filter(F.col("vec_id") % every == 0)
    blocks = max(1, -(-queries.count() // QUERY_BLOCK))
    # The cogrouped keys must have one type on both sides.
    part = lambda seed, n: F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(n)).cast("int")
    span = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    stored = rows.select("dim", part(1, shards).alias("shard"), span(blocks).alias("block"), "vec_id", "v")
    asked = queries.select("dim", part(2, blocks).alias("block"), span(shards).alias("shard"), "vec_id", "v")

    def answer(left: pa.Table, right: pa.Table) -> pa.Table:
        both = [[], [], []]
        if left.num_rows and right.num_rows:
            matrix = lambda t: (t.column("vec_id").to_numpy(), t.column("v").combine_chunks().flatten().to_numpy().reshape(t.num_rows, -1))
            for q, ids, scores in nearest_in_shard(*matrix(left), *matrix(right), k, factor):
                both[0] += [q] * len(ids)
                both[1] += ids.tolist()
                both[2] += scores.tolist()
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.table([pa.array(c, t) for c, t in zip(both, kinds, strict=True)], names=["query_id", "vec_id", "score"])

    unit = ["dim", "shard", "block"]
    found = stored.groupBy(*unit).cogroup(asked.groupBy(*unit)).applyInArrow(answer, RESULT)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)
