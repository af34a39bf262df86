"""Removal of repeated byte strings by a hash-compared sort of sampled suffixes.

A byte goes if a ``LENGTH``-byte string that covers it also starts in a document with a smaller id.  Two suffixes are compared by a
binary search for their common extension on prefix polynomial hashes and by the byte after it, so a comparison takes a
logarithmic number of steps; a mergesort orders them by it, and the result is verified byte by byte.

A suffix array of the whole corpus would shuffle every byte's suffix.  Here suffixes are sampled: a position is an anchor if its
``GRAM``-byte hash is the least in some ``LENGTH``-byte string around it.  Equal strings have the same anchors at the
same places, so it is enough to compare strings around anchors that several documents share:

1. The texts are shuffled once into parts of ``PART_BYTES`` and kept as a bucketed table; later joins on the part move no text.
2. Later copies of a whole text go as a whole (aggregation of digests) and take no part in what follows.
3. Each part asks, per hash bucket, which of its distinct anchor hashes (4 bytes within the bucket) other parts hold too.
4. For shared anchors the suffix around the anchor (``LENGTH`` bytes after it, LENGTH - GRAM before) is dealt by anchor hash.
   A part sends a suffix that several of its documents have once, for the smallest id; the others are settled on the spot.
5. Per bucket, the suffixes of each anchor are sorted, forwards from the anchor and backwards; the common extensions of
   neighbours tell which strings are equal, and all but those of the smallest id are marked.  Marks go back to the part, which cuts
   the bytes.

A very common passage costs one row per part and anchor.  Suffixes that differ (around the passage's ends) are sent per
document; at an anchor with more than ``HOT_ROWS`` rows in all parts they are not sent at all.  There a part sends the 128-bit digests of the
``LENGTH``-byte strings that have this anchor as their own (about 18, as every string has one), each once, with the smallest id, packed by the
bucket they are dealt to.  So a group has at most ``HOT_ROWS`` suffixes or, for a string, one entry of each part, however
many documents hold the passage.  Strings compared by digest are not compared again by bytes.

Parts stay at ``PART_BYTES`` whatever the corpus; above ``MAX_FILES`` of them, several share a file and a task, which handles them one by one.

Defined cases: null text is empty; texts shorter than ``LENGTH`` bytes stay; rows with a null id stay whole and are no source; rows that
share an id do not cut each other, and each is cut by its own text; equal rows get equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import bounded_batches
from orderloom.llm.words import mixed
from orderloom.session import materialise, shared_dir, stage_scope

LENGTH = 50
GRAM = 16
SPREAD = LENGTH - GRAM  # an anchor lies at most so many bytes after its string's start
PART_BYTES = 8 << 20
#: Files of the table of texts; more parts share them.
MAX_FILES = 50_000
#: Rows of an anchor in all parts above which digests of its strings are dealt instead of its suffixes.
HOT_ROWS = 10_000
#: Parts for each of the buckets that string digests are dealt to.
PARTS_PER_DEAL = 8
_BASE = 0x9E3779B97F4A7C15
_U = np.uint64


def _powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[0] = 1
    return np.multiply.accumulate(p)


def stretch_hashes(data: np.ndarray, length: int) -> np.ndarray:
    """Polynomial hash of the ``length`` bytes from each position on."""
    n = len(data)
    running = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + _U(1)) * _powers(_BASE, n), out=running[1:])
    back = _powers(pow(_BASE, -1, 1 << 64), n - length + 1)
    return mixed((running[length:] - running[:-length]) * back)


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        values = pick(values[: len(values) - span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def anchors(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions and hashes of the anchors of texts laid end to end (``starts`` has n + 1 entries), and the hash of the anchor
    that the string from each position on has (0 where it would run into the next text)."""
    if len(data) < LENGTH:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
    grams = stretch_hashes(data, GRAM)
    least = _sliding(grams, SPREAD + 1, np.minimum)
    # Strings that run into the next text have no anchors.
    ends = starts[1:][np.searchsorted(starts[1:], np.arange(len(least)), side="right")]
    least[np.arange(len(least)) + LENGTH > ends] = 0
    padded = np.concatenate([np.zeros(SPREAD, np.uint64), least, np.zeros(SPREAD, np.uint64)])
    at = np.flatnonzero((_sliding(padded, SPREAD + 1, np.maximum) == grams) & (grams > 0))
    return at, grams[at], least


def slices(table: pa.Table, skip: set[int], size: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Texts of a part end to end, without the rows (by ``rid``) of ``skip``, about ``size`` bytes at a time: bytes, starts, row
    numbers, ids."""
    texts, ids, rids = (table.column(c).to_pylist() for c in ("text", "doc_id", "rid"))
    held, rows, total = [], [], 0
    for row, (text, doc_id) in enumerate(zip(texts, ids, strict=True)):
        data = (text or "").encode()
        if doc_id is not None and rids[row] not in skip and len(data) >= LENGTH:
            held.append(data)
            rows.append(row)
            total += len(data)
        if held and (total >= size or row == len(texts) - 1):
            yield _joined(held), np.cumsum([0, *map(len, held)]), np.array(rows), np.array([ids[r] for r in rows])
            held, rows, total = [], [], 0
    if held:
        yield _joined(held), np.cumsum([0, *map(len, held)]), np.array(rows), np.array([ids[r] for r in rows])


def _joined(held: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(held), np.uint8)


def _copies(extra: pa.Table) -> set[int]:
    """Row ids of the part's copies of whole texts."""
    return {i for row in extra.column("copies").to_pylist() if row for i in row}


def _place(hashes: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket and 4-byte rest of a hash."""
    return (hashes >> _U(32)) % _U(buckets), hashes.astype(np.uint32)


def _ask(table: pa.Table, extra: pa.Table, buckets: int) -> pa.Table:
    """The part's distinct anchor hashes per bucket, and which of them it has several rows of: ``(place, rows)`` pairs."""
    found = [anchors(data, starts)[1] for data, starts, _, _ in slices(table, _copies(extra))]
    bucket, rest = _place(np.concatenate(found), buckets) if found else (np.empty(0, np.uint64), np.empty(0, np.uint32))
    codes, count = np.unique((bucket << _U(32)) | rest.astype(np.uint64), return_counts=True)
    bucket, rest = (codes >> _U(32)).astype(np.int64), codes.astype(np.uint32)
    cut = np.flatnonzero(np.diff(bucket, prepend=-1))
    blobs, several = [], []
    for hashes, n in zip(np.split(rest, cut[1:]), np.split(count, cut[1:]), strict=True) if len(rest) else ():
        blobs.append(hashes.tobytes())
        some = np.flatnonzero(n > 1)
        several.append(np.stack([some, n[some]]).astype(np.uint32).tobytes())
    part = table.column("part")[0].as_py() if table.num_rows else 0
    arrays = [pa.array(bucket[cut], pa.int64()), pa.array([part] * len(blobs), pa.int64()), pa.array(blobs, pa.binary()), pa.array(several, pa.binary())]
    return pa.table(arrays, names=["bucket", "part", "blob", "several"])


def _answer(asked: pa.Table, hot_rows: int) -> pa.Table:
    """For each part of a bucket: those of its hashes that other parts hold too, and which of them have more than ``hot_rows`` rows."""
    blobs = [np.frombuffer(b, np.uint32) for b in asked.column("blob").to_pylist()]
    values, where, count = np.unique(np.concatenate(blobs), return_inverse=True, return_counts=True)
    rows = count.astype(np.int64)
    start = 0
    for blob, more in zip(blobs, asked.column("several").to_pylist(), strict=True):
        place, n = np.frombuffer(more, np.uint32).reshape(2, -1).astype(np.int64)
        rows[where[start + place]] += n - 1  # a part's hashes are distinct
        start += len(blob)
    shared, hot = values[count > 1], values[(count > 1) & (rows > hot_rows)]
    kept, large = ([b[np.isin(b, x, assume_unique=True)].tobytes() for b in blobs] for x in (shared, hot))
    out = pa.table([asked.column("part"), asked.column("bucket"), pa.array(kept, pa.binary()), pa.array(large, pa.binary())], names=["part", "bucket", "blob", "hot"])
    return out.filter(pa.array([bool(k) for k in kept]))


def _codes(extra: pa.Table, column: str) -> np.ndarray:
    """One sorted list of the (bucket, rest) codes that the answers hold in ``column``."""
    held = [
        (_U(b) << _U(32)) | np.frombuffer(x, np.uint32).astype(np.uint64)
        for b, x in zip(extra.column("bucket").to_pylist(), extra.column(column).to_pylist(), strict=True)
        if x
    ]
    return np.sort(np.concatenate(held)) if held else np.empty(0, np.uint64)


SUFFIX = "h bigint, part bigint, rid bigint, doc_id bigint, at bigint, before int, suffix binary"


def _suffixes(table: pa.Table, extra: pa.Table, buckets: int) -> pa.Table:
    """Suffixes around the part's shared anchors, or digests of the strings of hot ones; what a smaller id of this part has too is
    settled here."""
    codes, hot_codes = _codes(extra, "blob"), _codes(extra, "hot")
    skip = _copies(extra)
    local: list[np.ndarray] = []
    for data, starts, _, ids in slices(table, skip):
        at, hashes, _ = anchors(data, starts)
        own = ids[np.searchsorted(starts, at, side="right") - 1]
        keys = np.unique(np.stack([hashes, own.astype(np.uint64)]), axis=1)[0] if len(at) else hashes
        local.append(keys)
    every, count = np.unique(np.concatenate(local), return_counts=True) if local else (np.empty(0, np.uint64), np.empty(0, int))
    several = every[count > 1]
    rids = table.column("rid").to_numpy()
    out: dict[str, list] = {c.split()[0]: [] for c in SUFFIX.split(", ")}
    strings: list[tuple[np.ndarray, ...]] = []
    for data, starts, rows, ids in slices(table, skip):
        at, hashes, least = anchors(data, starts)
        bucket, rest = _place(hashes, buckets)
        code = (bucket << _U(32)) | rest.astype(np.uint64)
        hot = np.isin(code, hot_codes)
        if hot.any():
            strings.append(_own_strings(data, starts, at[hot], hashes[hot], least, rids[rows], ids))
        pick = (np.isin(code, codes) | np.isin(hashes, several)) & ~hot
        at, hashes = at[pick], hashes[pick]
        text = np.searchsorted(starts, at, side="right") - 1
        low, high = np.maximum(at - SPREAD, starts[text]), np.minimum(at + LENGTH, starts[text + 1])
        raw = data.tobytes()
        out["h"] += hashes.view(np.int64).tolist()
        out["rid"] += rids[rows[text]].tolist()
        out["doc_id"] += ids[text].tolist()
        out["at"] += (at - starts[text]).tolist()
        out["before"] += (at - low).tolist()
        out["suffix"] += [raw[a:b] for a, b in zip(low.tolist(), high.tolist(), strict=True)]
    part = table.column("part")[0].as_py() if table.num_rows else 0
    columns = ("h", "rid", "doc_id", "at", "before", "suffix")
    rows, settled = _least(list(zip(*(out[c] for c in columns), strict=True)))
    settled = [(rid, at, -1) for _, rid, _, at, _, _ in settled]
    if strings:
        sent, more = _least_strings(*map(np.concatenate, zip(*strings, strict=True)))
        rows += [(bucket, 0, 0, 0, -2, blob) for bucket, blob in _packed_strings(*sent, max(1, buckets // PARTS_PER_DEAL))]
        settled += [(rid, start, 1) for rid, start in zip(*(v.tolist() for v in more), strict=True)]
    if settled:
        # What is settled here travels as one packed row.
        rows.append((part, 0, 0, 0, -1, packed(*np.array(settled, np.int64).T)))
    kinds = {c: pa.int32() if c == "before" else pa.binary() if c == "suffix" else pa.int64() for c in out}
    held = dict(zip(columns, zip(*rows, strict=True), strict=True)) if rows else dict.fromkeys(columns, ())
    held["part"] = [part] * len(rows)
    return pa.table([pa.array(list(held[c]), t) for c, t in kinds.items()], names=list(kinds))


def _own_strings(
    data: np.ndarray, starts: np.ndarray, at: np.ndarray, hashes: np.ndarray, least: np.ndarray, rids: np.ndarray, ids: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Digest, id, row and start of the strings whose own anchor is one of the given."""
    found = []
    for x in range(SPREAD + 1):
        start = at - x
        good = (start >= 0) & (start < len(least))
        found.append(start[good][least[start[good]] == hashes[good]])
    start = np.unique(np.concatenate(found))
    text = np.searchsorted(starts, start, side="right") - 1
    raw = data.tobytes()
    digests = b"".join(xxhash.xxh3_128_digest(raw[p : p + LENGTH]) for p in start.tolist())
    return np.frombuffer(digests, "V16"), ids[text], rids[text], (start - starts[text]).astype(np.uint32)


def _smallest(digest: np.ndarray, doc_id: np.ndarray) -> np.ndarray:
    """The smallest id among the entries of each entry's digest."""
    _, group = np.unique(digest, return_inverse=True)
    least = np.full(group.max(initial=-1) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, doc_id)
    return least[group]


def _least_strings(digest: np.ndarray, doc_id: np.ndarray, rid: np.ndarray, start: np.ndarray) -> tuple[tuple, tuple]:
    """The entries of the smallest id of each string, and row and start of the others."""
    first = _smallest(digest, doc_id) == doc_id
    return (digest[first], doc_id[first], rid[first], start[first]), (rid[~first], start[~first])


def _packed_strings(digest: np.ndarray, doc_id: np.ndarray, rid: np.ndarray, start: np.ndarray, deals: int) -> Iterator[tuple[int, bytes]]:
    """The entries of each bucket that has some, as one blob."""
    bucket = (digest.view(np.uint64).reshape(-1, 2)[:, 0] % _U(deals)).astype(np.int64)
    order = np.lexsort((start, rid, bucket))
    edge = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for own in np.split(order, edge[1:]) if len(order) else ():
        columns = (digest[own], doc_id[own].astype(np.int64), rid[own].astype(np.int64), start[own])
        yield int(bucket[own[0]]), b"".join(c.tobytes() for c in columns)


def _unpacked_strings(blob: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    n = len(blob) // 36
    return (
        np.frombuffer(blob, "V16", n), np.frombuffer(blob, np.int64, n, 16 * n),
        np.frombuffer(blob, np.int64, n, 24 * n), np.frombuffer(blob, np.uint32, n, 32 * n),
    )


def _mark_strings(parts: list[int], blobs: list[bytes]) -> list[tuple[int, bytes]]:
    """Per part the strings that a smaller id of another part has too."""
    held = [_unpacked_strings(b) for b in blobs]
    digest, doc_id, rid, start = (np.concatenate(c) for c in zip(*held, strict=True))
    gone = doc_id > _smallest(digest, doc_id)
    out, low = [], 0
    for part, (own, *_) in zip(parts, held, strict=True):
        mine = slice(low, low + len(own))
        if (some := gone[mine]).any():
            out.append((part, packed(rid[mine][some], start[mine][some], np.ones(some.sum(), np.int64))))
        low += len(own)
    return out


def _least(rows: list[tuple]) -> tuple[list[tuple], list[tuple]]:
    """Rows ``(h, rid, doc_id, at, before, suffix)`` of the smallest id of each window, and the others."""
    first: dict[tuple, int] = {}
    for _, _, doc_id, _, *key in rows:
        first[tuple(key)] = min(first.get(tuple(key), doc_id), doc_id)
    least = [first[row[4], row[5]] == row[2] for row in rows]
    return [r for r, k in zip(rows, least, strict=True) if k], [r for r, k in zip(rows, least, strict=True) if not k]


def packed(rid: np.ndarray, at: np.ndarray, marks: np.ndarray) -> bytes:
    return np.stack([rid, at, marks]).astype(np.int64).tobytes()


MARKS = "part bigint, marks binary"


class Suffixes:
    """Byte strings laid out as rows (value + 1, 0 beyond the end), with the polynomial hash of every prefix."""

    def __init__(self, rows: np.ndarray):
        self.rows, self.width = np.ascontiguousarray(rows), rows.shape[1]
        hashes = np.zeros((len(rows), self.width + 1), np.uint64)
        for c in range(self.width):
            hashes[:, c + 1] = hashes[:, c] * _U(_BASE) + rows[:, c]
        self.hashes = hashes.ravel()

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common beginning of each pair, by binary search on prefix hashes."""
        a_at, b_at = a * (self.width + 1), b * (self.width + 1)
        length = np.zeros(len(a), np.int64)
        step = 1 << (self.width.bit_length() - 1)
        while step:
            more = length + step
            inside = np.minimum(more, self.width)
            equal = (more == inside) & (self.hashes[a_at + inside] == self.hashes[b_at + inside])
            length = np.where(equal, more, length)
            step >>= 1
        return length

    def before(self, a: np.ndarray, b: np.ndarray, or_equal: np.ndarray) -> np.ndarray:
        """Whether a sorts before b; where ``or_equal``, also if they are equal."""
        length = self.common(a, b)
        end = length == self.width
        at = np.where(end, 0, length)
        return np.where(end, or_equal, self.rows[a, at] < self.rows[b, at])

    def sort(self, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row numbers sorted within each group (rows of a group lie side by side), and each one's common beginning with the one
        before it (-1 for a group's first).

        Bottom-up mergesort of all groups at once: a row finds its place in the neighbouring run by bisection.  Neighbours in
        the result are compared byte by byte; if a hash has deceived, all is sorted by the bytes.
        """
        n = len(group)
        first = np.flatnonzero(np.diff(group, prepend=group[:1] - 1)) if n else np.empty(0, np.int64)
        size = np.diff(np.append(first, n))
        low, high = np.repeat(first, size), np.repeat(first + size, size)
        order, run = np.arange(n), 1
        while n and run < size.max():
            at = np.flatnonzero(high - low > run)
            place = at - low[at]
            left = place // run % 2 == 0
            start = low[at] + (place // run + np.where(left, 1, -1)) * run
            stop = np.minimum(start + run, high[at])
            partner = start < high[at]
            at, left, start, stop = at[partner], left[partner], start[partner], stop[partner]
            lo, hi = start.copy(), stop.copy()
            open_ = np.arange(len(at))
            while len(open_):
                mid = (lo[open_] + hi[open_]) // 2
                ahead = self.before(order[mid], order[at[open_]], ~left[open_])
                lo[open_] = np.where(ahead, mid + 1, lo[open_])
                hi[open_] = np.where(ahead, hi[open_], mid)
                open_ = open_[lo[open_] < hi[open_]]
            merged = order.copy()
            merged[np.where(left, at, at - run) + lo - start] = order[at]
            order, run = merged, run * 2
        shared = np.full(n, -1, np.int64)
        inner = np.setdiff1d(np.arange(n), first, assume_unique=True)
        a, b = order[inner - 1], order[inner]
        shared[inner] = self.common(a, b)
        if not self._holds(a, b, shared[inner]):
            order = np.lexsort((*self.rows.T[::-1], group))
            a, b = order[inner - 1], order[inner]
            differ = self.rows[a] != self.rows[b]
            shared[inner] = np.where(differ.any(axis=1), differ.argmax(axis=1), self.width)
        return order, shared

    def _holds(self, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> bool:
        """Whether each b shares exactly ``length`` bytes with its a and does not sort before it."""
        left, right = self.rows[a], self.rows[b]
        wrong = ((left != right) & (np.arange(self.width) < length[:, None])).any()
        some = np.flatnonzero(length < self.width)
        at = length[some]
        return not wrong and bool((left[some, at] < right[some, at]).all())


def marked(before: np.ndarray, suffix: list[bytes], doc_id: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Per suffix a bit for each x: the string that starts x bytes before the anchor also starts in a smaller id.

    Rows of one anchor lie side by side.  Equal windows are one; the others are sorted by what follows the anchor's start and by
    what precedes it, backwards.  Two windows share the string at x if they have LENGTH - x bytes in common after and x before, which the
    sorted neighbours' common extensions tell.
    """
    n, width = len(suffix), SPREAD + LENGTH
    rows = np.zeros((n, width), np.uint8)
    after = np.array([len(s) for s in suffix]) - before
    sizes = after + before
    flat = np.frombuffer(b"".join(suffix), np.uint8)
    left = np.arange(n) * width + SPREAD - before - (np.cumsum(sizes) - sizes)
    rows.ravel()[np.repeat(left, sizes) + np.arange(len(flat))] = flat + np.uint8(1)  # no byte of UTF-8 is 255
    # Equal windows of an anchor; one that only looks equal by its hash stays on its own.
    code = np.zeros(n, np.uint64)
    for c in range(width):
        code = code * _U(_BASE) + rows[:, c]
    order = np.lexsort((code, anchor))
    new = np.ones(n, bool)
    new[1:] = (code[order[1:]] != code[order[:-1]]) | (anchor[order[1:]] != anchor[order[:-1]])
    new[1:] |= (rows[order[1:]] != rows[order[:-1]]).any(axis=1)
    window = np.empty(n, np.int64)
    window[order] = np.cumsum(new) - 1
    head = order[new]
    least = np.minimum.reduceat(doc_id[order], np.flatnonzero(new)) if n else doc_id
    out = np.zeros(n, np.int64)
    valid = lambda x, i: (before[i] >= x) & (after[i] >= LENGTH - x)
    # Windows that are alone at their anchor need no order.
    _, which, count = np.unique(anchor[head], return_inverse=True, return_counts=True)
    several = np.flatnonzero(count[which] > 1)
    rows, group = rows[head[several]], which[several]
    ahead, ahead_shared = Suffixes(rows[:, SPREAD:]).sort(group)
    back, back_shared = Suffixes(rows[:, SPREAD - 1 :: -1]).sort(group)
    right, behind = np.empty(len(several), np.int64), np.empty(len(several), np.int64)
    for x in range(SPREAD + 1):
        best = least.copy()
        use = np.flatnonzero(valid(x, head[several]))
        if len(use):
            right[ahead] = np.cumsum(ahead_shared < LENGTH - x)
            behind[back] = np.cumsum(back_shared < x)
            code = right[use] * (len(several) + 1) + behind[use]
            order = np.argsort(code)
            edge = np.flatnonzero(np.diff(code[order], prepend=-1))
            smallest = np.minimum.reduceat(least[several[use[order]]], edge)
            best[several[use[order]]] = np.repeat(smallest, np.diff(np.append(edge, len(order))))
        out[(doc_id > best[window]) & valid(x, slice(None))] |= 1 << x
    return out


def _mark(table: pa.Table) -> pa.Table:
    """Marks of a bucket of suffixes, some whole anchor groups at a time, packed per part.

    What a part has settled itself passes through with its marks.
    """
    through = table.filter(pc.equal(table.column("before"), -1))
    strings = table.filter(pc.equal(table.column("before"), -2))
    marked_strings = _mark_strings(strings.column("part").to_pylist(), strings.column("suffix").to_pylist()) if strings.num_rows else []
    table = table.filter(pc.greater_equal(table.column("before"), 0)).sort_by("h")
    h, part = table.column("h").to_numpy(), table.column("part").to_numpy()
    before, doc_id = table.column("before").to_numpy(), table.column("doc_id").to_numpy()
    suffix = table.column("suffix").to_pylist()
    marks = np.zeros(len(h), np.int64)
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(h)) + 1, [len(h)]])
    start = 0
    for i, end in enumerate(cuts[1:], 1):
        if end > start and (end - start >= 20_000 or i == len(cuts) - 1):
            marks[start:end] = marked(before[start:end], suffix[start:end], doc_id[start:end], h[start:end])
            start = end
    keep = np.flatnonzero(marks)
    keep = keep[np.argsort(part[keep], kind="stable")]
    rid, at = table.column("rid").to_numpy()[keep], table.column("at").to_numpy()[keep]
    edge = np.flatnonzero(np.diff(part[keep], prepend=-1))
    blobs = [packed(*x) for x in zip(*(np.split(v, edge[1:]) for v in (rid, at, marks[keep])), strict=True)] if len(keep) else []
    blobs += through.column("suffix").to_pylist() + [b for _, b in marked_strings]
    parts = [*part[keep][edge].tolist(), *through.column("part").to_pylist(), *(p for p, _ in marked_strings)]
    return pa.table([pa.array(parts, pa.int64()), pa.array(blobs, pa.binary())], names=["part", "marks"])


RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, kept binary"


def _cut(table: pa.Table, extra: pa.Table, keep_bytes: bool) -> pa.Table:
    """Remaining bytes of each document of a part, by its copies and marks."""
    skip = _copies(extra)
    blobs = [np.frombuffer(m, np.int64).reshape(3, -1) for m in extra.column("marks").to_pylist() if m]
    rids, places, bitmaps = np.concatenate(blobs, axis=1) if blobs else np.empty((3, 0), np.int64)
    order = np.argsort(rids, kind="stable")
    rids, places, bitmaps = rids[order], places[order], bitmaps[order]
    out: list[tuple] = []
    bits = np.arange(SPREAD + 1)
    for rid, doc_id, text in zip(*(table.column(c).to_pylist() for c in ("rid", "doc_id", "text")), strict=True):
        data = (text or "").encode()
        n, gone = len(data), np.zeros(0, bool)
        if rid in skip and n >= LENGTH:
            gone = np.ones(n, bool)
        elif (own := slice(*np.searchsorted(rids, [rid, rid + 1]))).start < own.stop:
            at, marks = places[own], bitmaps[own]
            starts = (at[:, None] - bits)[(marks[:, None] >> bits & 1).astype(bool)]
            starts = starts[(starts >= 0) & (starts + LENGTH <= n)]
            edge = np.bincount(starts, minlength=n + 1) - np.bincount(starts + LENGTH, minlength=n + 1)[: n + 1]
            gone = np.cumsum(edge)[:n] > 0
        kept = np.frombuffer(data, np.uint8)[~gone].tobytes() if len(gone) else data
        spans = int(np.count_nonzero(np.diff(gone.astype(np.int8), prepend=0) == 1))
        out.append((doc_id, n, int(gone.sum()), spans, hashlib.sha256(kept).hexdigest(), kept if keep_bytes else None))
    kinds = [pa.int64()] * 4 + [pa.string(), pa.binary()]
    columns = zip(*out, strict=True) if out else [[]] * 6
    return pa.table([pa.array(list(c), t) for c, t in zip(columns, kinds, strict=True)], names=[c.split()[0] for c in RESULT.split(", ")])


def deduplicate(docs: DataFrame, keep_bytes: bool = True, part_bytes: int = PART_BYTES, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Per row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 and (with ``keep_bytes``) the remaining bytes."""
    spark = docs.sparkSession
    bounded_batches(spark)
    total = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = max(1, -(-total // part_bytes))
    files = min(parts, MAX_FILES)
    result, table = shared_dir(spark, "dedup-result"), f"dedup_texts_{uuid.uuid4().hex}"
    rows = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    # The part follows from the row number, so a recomputed task deals its rows the same way.
    rows = rows.withColumn("part", F.pmod(F.xxhash64("rid"), F.lit(parts)))
    with stage_scope(spark):
        texts = rows.repartition(files, "part").write.bucketBy(files, "part").option("compression", "zstd")
        texts.format("parquet").option("path", shared_dir(spark, "dedup-texts")).saveAsTable(table)
        try:
            held = _deduplicated(spark.table(table), parts, hot_rows, keep_bytes, result)
        finally:
            spark.sql(f"DROP TABLE IF EXISTS {table}")
    return held if keep_bytes else held.drop("kept")


def _deduplicated(held: DataFrame, parts: int, hot_rows: int, keep_bytes: bool, path: str) -> DataFrame:
    sums = materialise(
        held.filter(F.col("doc_id").isNotNull()).select("part", "rid", "doc_id", F.sha2(F.coalesce("text", F.lit("")), 256).alias("sum")), "dedup-sums"
    )
    first = sums.groupBy("sum").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).filter(F.col("first") < F.col("last"))
    copies = sums.join(first, "sum").filter(F.col("doc_id") > F.col("first")).groupBy("part").agg(F.collect_set("rid").alias("copies"))
    copies = materialise(copies, "dedup-copies")

    def with_parts(run, extra: DataFrame, schema: str) -> DataFrame:
        return held.groupBy("part").cogroup(extra.groupBy("part")).applyInArrow(run, schema)

    asked = with_parts(lambda a, b: _ask(a, b, parts), copies, "bucket bigint, part bigint, blob binary, several binary")
    answers = asked.groupBy("bucket").applyInArrow(lambda t: _answer(t, hot_rows), "part bigint, bucket bigint, blob binary, hot binary")
    extra = copies.unionByName(answers, allowMissingColumns=True)
    suffixes = with_parts(lambda a, b: _suffixes(a, b, parts), extra, SUFFIX)
    deal = F.when(F.col("before") == -2, F.col("h")).otherwise(F.pmod(F.xxhash64("h"), F.lit(parts)))
    marks = suffixes.withColumn("deal", deal).groupBy("deal").applyInArrow(lambda t: _mark(t.drop_columns(["deal"])), MARKS)
    extra = copies.unionByName(marks, allowMissingColumns=True)
    return materialise(with_parts(lambda a, b: _cut(a, b, keep_bytes), extra, RESULT), "dedup-result", path)
