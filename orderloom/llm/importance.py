"""Importance resampling towards a target distribution: documents whose word features look like the target's are drawn more often.

Words and word pairs are hashed into ``BUCKETS`` buckets.  A bucket's gain is the scaled log ratio of its smoothed share in the target to that
in the corpus, a signed integer.  A document's bucket counts are kept as bit planes (plane k holds bit k of every count) and so are the gains,
positive and negative ones apart: AND of a count plane and a gain plane, popcount, and a sum weighted by powers of two give the exact total gain.
The mean gain plus Gumbel noise from a hash of the id is the score; the highest scores are drawn.

Scale: two passes over the texts, both without a shuffle of texts or features: the first adds bucket totals inside each task and shuffles one row a
bucket and task, the second returns three numbers a document.  ``BUCKETS`` gains reach the tasks, whatever the corpus.  Ranks come from a range sort of the
narrow scores.  Tasks hold one Arrow batch (a bounded number of bytes, or one longer text) and the planes of ``CHUNK`` documents.

Defined cases: a null or empty text has no features and weight 0, and still a score; a null id is hashed as ``7:-`` and comes last among ties; rows that share an id
are documents of their own; equal rows have equal scores and neighbouring ranks; with an empty corpus or target all of its shares are equal.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import bounded_batches, numbered
from orderloom.session import materialise

BUCKETS = 10_000
LEAST_WORDS = 20
DRAWN_PERCENT = 25
SEED = 7
CHUNK = 1024
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of every word and pair of neighbouring words, and the document each belongs to."""
    clean = pc.replace_substring_regex(pc.ascii_lower(pc.fill_null(texts.cast(pa.large_string()), "")), NOT_WORD, " ")
    lists = pc.split_pattern(clean, " ")
    flat = lists.flatten()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    owner = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))[full]
    coded = flat.filter(pa.array(full)).dictionary_encode()
    if not len(coded):
        return np.empty(0, np.int64), owner
    word = [w.encode() for w in coded.dictionary.to_pylist()]
    code = coded.indices.to_numpy()
    single = np.array([zlib.crc32(w) for w in word], np.uint32)[code]
    # The checksum of a pair goes on from that of its first word and the space.
    begun = np.array([zlib.crc32(b" ", zlib.crc32(w)) for w in word], object)
    paired = np.flatnonzero(owner[1:] == owner[:-1])
    second = np.array(word, object)[code[paired + 1]]
    pair = np.fromiter(map(zlib.crc32, second, begun[code[paired]]), np.uint32, len(paired))
    return np.concatenate([single, pair]).astype(np.int64) % BUCKETS, np.concatenate([owner, owner[paired]])


def bucket_totals(texts: DataFrame) -> np.ndarray:
    """How many features of all texts fall in each bucket."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            total += np.bincount(features(batch.column(0))[0], minlength=BUCKETS)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there, pa.int32()), pa.array(total[there], pa.int64())], ["bucket", "n"])

    sums = texts.select("text").mapInArrow(add, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(BUCKETS, np.int64)
    for row in sums.collect():  # at most BUCKETS rows
        out[row["bucket"]] = row["n"]
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Scaled log ratio of smoothed shares, rounded down."""
    s_all, t_all = float(corpus.sum() + BUCKETS), float(target.sum() + BUCKETS)
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for s, t in pairs], np.int64)


def plane(bits: np.ndarray) -> np.ndarray:
    """Rows of booleans packed into 64-bit words."""
    packed = np.packbits(bits, axis=-1)
    room = -packed.shape[-1] % 8
    return np.pad(packed, [(0, 0)] * (packed.ndim - 1) + [(0, room)]).view(np.uint64)


def gain_planes(gain: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """(signed power of two, buckets whose gain of that sign has the bit)."""
    out = []
    for sign in (1, -1):
        size = np.maximum(sign * gain, 0)
        for bit in range(int(size.max(initial=0)).bit_length()):
            out.append((sign * (1 << bit), plane((size >> bit & 1).astype(bool))))
    return out


def total_gains(buckets: np.ndarray, owner: np.ndarray, n: int, planes: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Exact sum over each document's features of their buckets' gains."""
    out = np.zeros(n, np.int64)
    order = np.argsort(owner, kind="stable")
    keys, counts = np.unique(owner[order] * BUCKETS + buckets[order], return_counts=True)
    doc, bucket = np.divmod(keys, BUCKETS)
    for start in range(0, n, CHUNK):
        a, b = np.searchsorted(doc, [start, start + CHUNK])
        held, where, count = doc[a:b] - start, bucket[a:b], counts[a:b]
        for bit in range(int(count.max(initial=0)).bit_length()):
            on = np.flatnonzero(count >> bit & 1)
            rows, at = np.unique(held[on], return_inverse=True)
            dense = np.zeros((len(rows), BUCKETS), bool)
            dense[at, where[on]] = True
            mine = plane(dense)
            for power, theirs in planes:
                out[start + rows] += (power << bit) * np.bitwise_count(mine & theirs).sum(axis=1, dtype=np.int64)
    return out


def weigh(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """``(doc_id, n_features, weight)``: the mean gain of each document's features, rounded down."""
    planes = gain_planes(gain)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buckets, owner = features(batch.column(1))
            n = np.bincount(owner, minlength=batch.num_rows)
            weight = np.where(n > 0, total_gains(buckets, owner, batch.num_rows, planes) // np.maximum(n, 1), 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(weight, pa.int64())], ["doc_id", "n_features", "weight"])

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").mapInArrow(run, "doc_id bigint, n_features bigint, weight bigint")


def scored(weights: DataFrame, seed: int = SEED) -> DataFrame:
    """Adds ``score``: the weight plus Gumbel noise of the id's hash, so that the highest scores are a draw by weight without replacement."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("-")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("bigint")
    noise = F.floor(F.lit(-1000) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")
    return weights.withColumn("score", F.col("weight") + noise)


def resample(docs: DataFrame, target: DataFrame, percent: int = DRAWN_PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """Every document with ``n_features``, ``weight``, ``score`` and, if it is drawn, its ``rank``.

    ``percent`` of the documents with at least ``least_words`` words are drawn, ties to the smaller id.
    """
    bounded_batches(docs.sparkSession)
    gain = gains(bucket_totals(docs), bucket_totals(target))
    held = materialise(scored(weigh(docs, gain)), "importance_scores")
    # w words have 2 w - 1 features.
    enough = F.col("n_features") >= 2 * least_words - 1
    drawn = percent * held.filter(enough).count() // 100
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("weight"), F.col("n_features")]
    placed = numbered(held.filter(enough), order, "place", "importance_order")
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = held.filter(~enough).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return placed.select(*columns, rank.alias("rank")).unionByName(rest)
