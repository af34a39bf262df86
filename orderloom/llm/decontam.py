"""Benchmark decontamination: BM25 over an inverted index of test items with block-max WAND, then overlap of question and answer.

Test items are cut into segments of at most ``SEGMENT`` words.  The index has a posting list per term: the segments that hold it, ascending, with
its impact on each, and for every run of a list within ``BLOCK`` neighbouring segments its place and greatest impact.  An impact is
the BM25 weight divided by the segment's score for itself, so a passage's score is a share and one threshold serves all items.

Every document is read in passages of ``WINDOW`` words, one every ``STRIDE``, so that any segment lies whole in a passage.  Passages are
queries, evaluated a batch at a time:

1. Pivot: a passage's terms are ordered by the greatest impact of their lists; those that together stay below (a share of) the threshold cannot
   make a hit alone, so only the lists of the others are opened.
2. Skip: their runs give the blocks a passage may hit; the greatest impacts of its terms there bound its score, first with whole-list
   bounds for the unopened lists, then with their runs in that block.  Blocks below the threshold are skipped.
3. In the blocks that are left the postings of the passage's terms are added up by segment.

All segments above the threshold are retrieved, then verified on the words around the hit: the question's and the answer's word trigrams must each recur
there by ``OVERLAP``.  Work follows the postings that a passage's terms have, not the size of the index.

Scale: the index of at most ``INDEX_BYTES`` of item text is sent to the tasks; a larger benchmark is searched in several passes over
the documents, its document frequencies counted over all items all the same.  Documents are neither shuffled nor collected; a task
holds one Arrow batch.

Defined cases: null or wordless texts and items match nothing; an item of one sentence is all question;
a part of fewer than three words is taken as found; each row has its own
result, whatever its id; items that share an id are separate; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import bounded_batches, row_key
from orderloom.llm.words import words

SEGMENT, WINDOW, STRIDE = 40, 80, 40
BLOCK = 16
THRESHOLD = 0.6
OVERLAP = 0.6
GRAM = 3
K1, B = 1.2, 0.75
INDEX_BYTES = 8 << 20
#: Share of the threshold that a passage's unopened lists may reach together.  Up to 1 no hit is lost; with less, more lists are opened and the
#: first bound rules out more blocks, which costs less here.
CLOSED = 0.25
#: Runs or terms that are looked at together.
OPENED = 1 << 20


def question_answer(text: str) -> tuple[str, str]:
    """Split at an ``Answer:`` mark, else before the last sentence."""
    marked = re.split(r"(?i)\banswer\s*:", text, maxsplit=1)
    if len(marked) == 2:
        return marked[0], marked[1]
    sentences = [s for s in re.split(r"(?<=[.!?])\s+", text.strip()) if s]
    return (" ".join(sentences[:-1]), sentences[-1]) if len(sentences) > 1 else (text, "")


def split_words(text: str) -> list[str]:
    return words(pa.array([text]))[0].to_pylist()


@dataclass
class Item:
    item_id: int | None
    length: int
    question: np.ndarray
    answer: np.ndarray


@dataclass
class Index:
    """Posting lists by term and, for skipping, their runs within a block of segments.

    ``runs`` of term t are ``run_start[t]`` to ``run_start[t + 1]``: their block, greatest impact, and place in the postings
    ``(segment, impact)``; ``most`` is a list's greatest impact, ``run_key`` orders runs by (term, block).
    """

    vocabulary: pa.Array
    items: list[Item]
    owner: np.ndarray  # item of each segment
    segment: np.ndarray
    impact: np.ndarray
    run_start: np.ndarray
    run_block: np.ndarray
    run_most: np.ndarray
    run_from: np.ndarray
    run_to: np.ndarray
    run_key: np.ndarray
    most: np.ndarray

    @property
    def blocks(self) -> int:
        return -(-len(self.owner) // BLOCK) + 1


def grams(ids: np.ndarray, n: int = GRAM) -> np.ndarray:
    """Distinct hashes of the word n-grams; fewer words than n have none."""
    if len(ids) < n:
        return np.empty(0, np.uint64)
    code = np.zeros(len(ids) - n + 1, np.uint64)
    for j in range(n):
        code = (code + ids[j : len(ids) - n + 1 + j].astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        code ^= code >> np.uint64(29)
    return np.unique(code)


def build(items: list[tuple[int, str]], df: dict[str, int], total: int) -> Index:
    """The index of these items; ``df`` counts the items of the whole benchmark (``total``) that hold a word."""
    texts = [(i, *question_answer(t or "")) for i, t in items]
    texts = [(i, split_words(q), split_words(a)) for i, q, a in texts]
    vocabulary = sorted({w for _, q, a in texts for w in (*q, *a)})
    place = {w: i for i, w in enumerate(vocabulary)}
    ids = lambda ws: np.array([place[w] for w in ws], np.int64)
    idf = np.array([np.log(1 + (total - df[w] + 0.5) / (df[w] + 0.5)) for w in vocabulary])
    held = [Item(i, len(q) + len(a), grams(ids(q)), grams(ids(a))) for i, q, a in texts]
    segments = []
    for number, (_, q, a) in enumerate(texts):
        every = ids([*q, *a])
        parts = -(-len(every) // SEGMENT) or 1
        segments += [(number, s) for s in np.array_split(every, parts) if len(s)]
    mean = np.mean([len(s) for _, s in segments]) if segments else 1
    lists: list[tuple[np.ndarray, ...]] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    for place_, (_, s) in enumerate(segments):
        own, tf = np.unique(s, return_counts=True)
        weight = idf[own] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * len(s) / mean))
        lists.append((own, np.full(len(own), place_), weight / weight.sum()))
    term, segment, impact = (np.concatenate(c) for c in zip(*lists, strict=True))
    order = np.lexsort((segment, term))
    term, segment, impact = term[order], segment[order], impact[order]
    blocks = -(-len(segments) // BLOCK) + 1
    run_key, first = np.unique(term * blocks + segment // BLOCK, return_index=True)
    greatest = lambda at: np.maximum.reduceat(impact, at) if len(impact) else np.empty(0)
    list_start = np.searchsorted(term, np.arange(len(vocabulary)))  # every word of the vocabulary is in some segment
    return Index(
        pa.array(vocabulary, pa.string()), held, np.array([n for n, _ in segments], np.int64), segment, impact,
        np.searchsorted(run_key // blocks, np.arange(len(vocabulary) + 1)), run_key % blocks, greatest(first), first,
        np.append(first[1:], len(term)) if len(first) else first, run_key, greatest(list_start),
    )


def passages(offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, start and end of all passages."""
    lengths = np.diff(offsets)
    counts = np.where(lengths > 0, np.maximum(1, -(-(lengths - WINDOW) // STRIDE) + 1), 0)
    text = np.repeat(np.arange(len(lengths)), counts)
    nth = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    start = offsets[text] + nth * STRIDE
    return text, start, np.minimum(start + WINDOW, offsets[text + 1])


def _spread(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For ranges of positions: which range each position is of, and the position."""
    size = end - start
    which = np.repeat(np.arange(len(size)), size)
    return which, np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + start[which]


def _added(keys: np.ndarray, values: np.ndarray, space: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys below ``space``, ascending, and the sum of their values, which are positive."""
    if space <= 8 * len(keys):
        sums = np.bincount(keys, values, space)
        found = np.flatnonzero(sums)
        return found, sums[found]
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, values, len(found))


def retrieve(index: Index, ids: np.ndarray, start: np.ndarray, end: np.ndarray, size: int = 2048) -> Iterator[tuple[int, int, float]]:
    """``(passage, item, score)`` of all segments that reach the threshold."""
    if not len(index.owner):
        return
    enough = THRESHOLD - 1e-6
    unknown = len(index.vocabulary)
    most = np.append(index.most, 0.0)
    padded = np.concatenate([ids, np.full(WINDOW, unknown)])
    for low in range(0, len(start), size):
        first, last = start[low : low + size], end[low : low + size]
        place = first[:, None] + np.arange(WINDOW)
        terms = np.where(place < last[:, None], padded[place], unknown)
        terms.sort(axis=1)
        terms[:, 1:][terms[:, 1:] == terms[:, :-1]] = unknown  # a term counts once
        # Pivot: terms by their lists' bounds; up to the pivot they stay below the threshold together.
        bound = most[terms]
        order = np.argsort(bound, axis=1, kind="stable")
        terms, bound = np.take_along_axis(terms, order, 1), np.take_along_axis(bound, order, 1)
        reach = np.cumsum(bound, axis=1)
        opened = (reach >= enough * CLOSED) & (bound > 0)
        closed = np.where(opened, 0.0, bound).sum(axis=1)
        row, column = np.nonzero(opened)
        if not len(row):
            continue
        # A few passages at a time, by the runs that they open.
        cost = np.bincount(row, (index.run_start[1:] - index.run_start[:-1])[terms[row, column]], len(first)).astype(np.int64)
        cuts = np.unique(np.searchsorted(np.cumsum(cost), np.arange(0, cost.sum() + OPENED, OPENED)))
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(first)], strict=True):
            mine = slice(*np.searchsorted(row, [a, b]))
            for passage, segment, score in _scored(index, terms, closed, row[mine], column[mine], enough):
                yield low + passage, int(index.owner[segment]), score


def _scored(
    index: Index, terms: np.ndarray, closed: np.ndarray, row: np.ndarray, column: np.ndarray, enough: float
) -> Iterator[tuple[int, int, float]]:
    """``(passage, segment, score)`` of the hits of passages whose opened lists are ``terms[row, column]``."""
    blocks, unknown = index.blocks, len(index.vocabulary)
    # Runs of the opened lists: blocks that a passage may hit, bounded by the runs and the closed lists.
    term = terms[row, column]
    which, run = _spread(index.run_start[term], index.run_start[term + 1])
    every, sums = _added(row[which] * blocks + index.run_block[run], index.run_most[run], len(terms) * blocks)
    every = every[sums + closed[every // blocks] >= enough]
    for low in range(0, len(every), OPENED // WINDOW):
        pairs = every[low : low + OPENED // WINDOW]
        # What all of the passage's terms have in such a block.
        pair, place = _spread(np.zeros(len(pairs), np.int64), np.full(len(pairs), WINDOW))
        term = terms[pairs[pair] // blocks, place]
        known = term < unknown
        pair, key = pair[known], term[known] * blocks + pairs[pair[known]] % blocks
        run = np.minimum(np.searchsorted(index.run_key, key), len(index.run_key) - 1)
        there = index.run_key[run] == key
        pair, run = pair[there], run[there]
        alive = np.bincount(pair, index.run_most[run], len(pairs)) >= enough
        pair, run = pair[alive[pair]], run[alive[pair]]
        which, posting = _spread(index.run_from[run], index.run_to[run])
        passage = pairs[pair[which]] // blocks
        found, score = _added(passage * len(index.owner) + index.segment[posting], index.impact[posting], len(terms) * len(index.owner))
        hit = score >= enough
        for key, value in zip(found[hit].tolist(), score[hit].tolist(), strict=True):
            yield key // len(index.owner), key % len(index.owner), value


def verified(item: Item, ids: np.ndarray, low: int, high: int) -> tuple[float, float]:
    """Shares of the item's question and answer trigrams found among the words from ``low`` to ``high``."""
    around = ids[max(0, low) : high]
    near = grams(around)
    share = lambda want: 1.0 if not len(want) else float(np.isin(want, near).mean())
    return share(item.question), share(item.answer)


RESULT = "key string, doc_id bigint, item_id bigint, score double, question_overlap double, answer_overlap double"


def _pass(docs: DataFrame, index: Index) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, offsets = words(batch.column(2))
            found = pc.index_in(flat, value_set=index.vocabulary)
            ids = pc.fill_null(found, len(index.vocabulary)).to_numpy().astype(np.int64)
            text, start, end = passages(offsets)
            best: dict[tuple[int, int], tuple[float, float, float]] = {}
            for p, n, score in retrieve(index, ids, start, end):
                item, t = index.items[n], text[p]
                low, high = max(offsets[t], start[p] - item.length), min(offsets[t + 1], end[p] + item.length)
                q, a = verified(item, ids, low, high)
                if q >= OVERLAP and a >= OVERLAP:
                    old = best.get((t, n), (0.0, 0.0, 0.0))
                    best[t, n] = max(old, (score, q, a))
            if best:
                rows = [t for t, _ in best]
                columns = [batch.column(0).take(pa.array(rows)), batch.column(1).take(pa.array(rows)), pa.array([index.items[n].item_id for _, n in best], pa.int64())]
                columns += [pa.array([v[k] for v in best.values()], pa.float64()) for k in range(3)]
                yield pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in RESULT.split(", ")])

    return docs.select(row_key(F.col("doc_id"), F.col("text")).alias("key"), F.col("doc_id").cast("bigint"), "text").mapInArrow(run, RESULT)


def _item_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        flat, offsets = words(batch.column(0))
        own = [w for i in range(batch.num_rows) for w in set(flat[offsets[i] : offsets[i + 1]].to_pylist())]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.string())], ["word"])


def contaminated(docs: DataFrame, benchmark: DataFrame, index_bytes: int = INDEX_BYTES) -> DataFrame:
    """``(key, doc_id, item_id, score, question_overlap, answer_overlap)`` of every document and item found in it."""
    bounded_batches(docs.sparkSession)
    items = benchmark.select(F.col("item_id").cast("bigint").alias("item_id"), F.coalesce("text", F.lit("")).alias("text"))
    size = items.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    passes = max(1, -(-size["bytes"] // index_bytes))
    df = items.select("text").mapInArrow(_item_words, "word string").groupBy("word").agg(F.count("*").alias("n"))
    parts = []
    for p in range(passes):
        # Each pass holds about index_bytes of items and their words.
        held = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(passes)) == p)
        rows = [(r["item_id"], r["text"]) for r in held.collect()]
        own = held.select("text").mapInArrow(_item_words, "word string").distinct()
        counts = {r["word"]: r["n"] for r in df.join(own, "word", "left_semi").collect()}
        parts.append(_pass(docs, build(sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])), counts, size["n"])))
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents in which no test item was found; rows and columns otherwise as they are."""
    hit = contaminated(docs, benchmark).select(F.col("key").alias("__key")).distinct()
    return docs.join(hit, row_key(docs["doc_id"], docs["text"]) == F.col("__key"), "left_anti")
