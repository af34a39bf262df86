"""Vectorised word handling of Arrow text batches: words, word hashes, shingles."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every output bit depends on every input bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Lower-case runs of letters, marks and digits of all texts in a row, and where each text's words start (n + 1)."""
    clean = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")), r"[^\pL\pM\pN]+", " ")
    lists = pc.split_pattern(clean, " ")
    flat = lists.flatten()
    full = pc.not_equal(flat, "").to_numpy(zero_copy_only=False)
    raw = lists.offsets.to_numpy() - lists.offsets[0].as_py()
    return flat.filter(pa.array(full)), np.concatenate([[0], np.cumsum(full)])[raw].astype(np.int64)


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, and the texts' offsets.  Each distinct word of the batch is hashed once."""
    flat, offsets = words(texts)
    coded = flat.dictionary_encode()
    table = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in coded.dictionary.to_pylist()), np.uint64, len(coded.dictionary))
    return table[coded.indices.to_numpy()] if len(flat) else np.empty(0, np.uint64), offsets


def shingles(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all n-word shingles and their offsets; a text of 1 to n - 1 words is one shingle of all its words."""
    lengths = np.diff(offsets)
    counts = np.where(lengths >= n, lengths - n + 1, (lengths > 0).astype(np.int64))
    out_offsets = np.concatenate([[0], np.cumsum(counts)])
    owner = np.repeat(np.arange(len(lengths)), counts)
    start = offsets[owner] + np.arange(out_offsets[-1]) - out_offsets[owner]
    padded = np.concatenate([hashes, np.zeros(n, np.uint64)])
    end = offsets[owner + 1]
    acc = np.zeros(len(start), np.uint64)
    for j in range(n):
        acc = acc * _MULTIPLIER + np.where(start + j < end, padded[start + j], np.uint64(0))
    return mixed(acc), out_offsets


def distinct_per_text(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each text, and their offsets."""
    owner = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    first = np.ones(len(v), bool)
    first[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
    counts = np.bincount(o[first], minlength=len(offsets) - 1)
    return v[first], np.concatenate([[0], np.cumsum(counts)])
