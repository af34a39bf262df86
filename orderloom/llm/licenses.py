"""License scan: TF-IDF cosine of passages to license templates, then inheritance from the nearest ancestor directory.

A text is read in windows of words: three fixed widths (about a notice line, a header, a license paragraph) and the length of each
template, so an exact notice has a window of its own.  A window's vector has TF-IDF weights, from the document frequencies of all
words over all files.  Tasks get the weights of the templates' words and of the most frequent ones (at most ``FREQUENT``); any other
word weighs at least as much as the most frequent word left out, so a bound from running sums rules windows out.  Windows whose
words are all known get their cosine at once; the few others that may still reach the threshold are joined with the frequencies of
their rare words.  The best template at or above ``THRESHOLD`` is the file's own license; below it, the score is the best of the
windows that the bound left.

A file without one inherits from license files (by ``is_license`` where it is given, else by name or if the window that gave the
license has at least ``LICENSE_SHARE`` of the file's words) of the nearest ancestor directory: every
ancestor path of a directory is a row, joined by equality with the directories that have license files, and the deepest wins.
Directories are distinct rows, so a directory with most files is one row in these joins.

Defined cases: null text has no license; null paths have no directory and inherit nothing; equal rows get equal results; of several license
files of a directory the best score wins, then the template first by name; the result has one row per input row; empty tables
give an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import bounded_batches
from orderloom.llm.words import distinct_per_text, word_hashes, words
from orderloom.session import materialise

# Notices and opening sentences of common licenses.
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License",
    ],
    "BSD-3-Clause": [
        "Licensed under the BSD 3-Clause License",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"],
    "GPL-2.0": ["Licensed under the GNU General Public License, version 2"],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License",
    ],
    "LGPL-3.0": ["Licensed under the GNU Lesser General Public License, version 3"],
    "MIT": [
        "Released under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "MPL-2.0": ["This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"],
}
#: Fixed widths; those of the templates are added.
WIDTHS = (6, 10, 20)
THRESHOLD = 0.75
#: At most so many words' weights are sent to every task; the others are joined.
FREQUENT = 50_000
LICENSE_SHARE = 0.5
LICENSE_FILE = r"(?i)^(?:licen[cs]e|copying|notice)(?:[.-].*)?$"


def template_words() -> tuple[list[str], list[str], np.ndarray]:
    """Vocabulary, license of each template, and term counts (templates x vocabulary)."""
    texts = [(name, t) for name, ts in sorted(TEMPLATES.items()) for t in ts]
    split = [words(pa.array([t]))[0].to_pylist() for _, t in texts]
    vocabulary = sorted({w for ws in split for w in ws})
    counts = np.zeros((len(texts), len(vocabulary)))
    for row, ws in enumerate(split):
        for w in ws:
            counts[row, vocabulary.index(w)] += 1
    return vocabulary, [name for name, _ in texts], counts


def document_frequencies(files: DataFrame) -> DataFrame:
    """``(h, n)``: files that hold each word, by the word's hash; the null hash has the number of files."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, n = np.unique(distinct_per_text(*word_hashes(batch.column(0)))[0], return_counts=True)
            hashes = pa.concat_arrays([pa.array(h.view(np.int64)), pa.array([None], pa.int64())])
            yield pa.RecordBatch.from_arrays([hashes, pa.array(np.append(n, batch.num_rows))], ["h", "n"])

    return files.select("text").mapInArrow(count, "h bigint, n bigint").groupBy("h").agg(F.sum("n").alias("n"))


class Weights(NamedTuple):
    """Words with known weights by sorted hash, their place among the templates' words (or the number of these), and the least
    weight of all other words."""

    hashes: np.ndarray
    idf: np.ndarray
    term: np.ndarray
    rest: float


def known_weights(frequencies: DataFrame, vocabulary: list[str], total: int) -> tuple[Weights, bool]:
    """Weights of the templates' and the most frequent words, and whether these are all words."""
    by_size = {r["b"]: r["count"] for r in frequencies.filter("h is not null").groupBy(F.length(F.bin("n")).alias("b")).count().collect()}
    bits, held = max(by_size, default=0) + 1, 0
    while bits > 1 and held + by_size.get(bits - 1, 0) <= FREQUENT:
        bits -= 1
        held += by_size.get(bits, 0)
    terms = word_hashes(pa.array([" ".join(vocabulary)]))[0]
    common = frequencies.filter("h is not null").filter((F.col("n") >= 1 << (bits - 1)) | F.col("h").isin(terms.view(np.int64).tolist())).toArrow()
    n = dict.fromkeys(terms.view(np.int64).tolist(), 0) | dict(zip(common.column("h").to_pylist(), common.column("n").to_pylist(), strict=True))
    hashes = np.array(list(n), np.int64).view(np.uint64)
    term = np.append(np.arange(len(terms)), np.full(len(n) - len(terms), len(terms)))
    order = np.argsort(hashes)
    idf = np.log((1 + total) / (1 + np.array(list(n.values())))) + 1
    return Weights(hashes[order], idf[order], term[order], float(np.log(max(1.0, (1 + total) / (1 << (bits - 1)))) + 1)), bits == 1


class Window(NamedTuple):
    """A window with words of unknown weight: product with its best template, squared norm of the known words, its
    length, and the others."""

    dot: float
    which: int
    norm2: float
    words: int
    others: list[dict]


def best_windows(hashes: np.ndarray, offsets: np.ndarray, known: Weights, templates: np.ndarray, widths: list[int], threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[list[Window]]]:
    """Best cosine of each text, its template and the window's words, by windows of known words; and each text's other windows that may be better.

    ``templates`` are unit rows.
    """
    n, terms = len(offsets) - 1, templates.shape[1]
    best, which, length = np.zeros(n), np.zeros(n, np.int64), np.zeros(n, np.int64)
    open_: list[list[tuple[float, Window]]] = [[] for _ in range(n)]
    at = np.minimum(np.searchsorted(known.hashes, hashes), len(known.hashes) - 1)
    here = known.hashes[at] == hashes
    term, idf = np.where(here, known.term[at], terms), np.where(here, known.idf[at], known.rest)
    own = np.zeros(terms)
    own[known.term[known.term < terms]] = known.idf[known.term < terms]
    weight = np.concatenate([templates * own, np.zeros((len(templates), 1))], axis=1).T
    sums = lambda v: np.concatenate([[0.0], np.cumsum(v)])
    near, gain, mass = sums(term < terms), sums(weight.max(axis=1)[term]), sums(idf**2)
    fill = np.zeros(max(widths))
    words_, term, idf, here = np.append(hashes, fill.astype(np.uint64)), np.append(term, fill.astype(np.int64) + terms), np.append(idf, fill), np.append(here, fill == 0)
    for width in widths:
        counts = np.where(np.diff(offsets) > 0, np.maximum(np.diff(offsets) - width, 0) + 1, 0)
        text = np.repeat(np.arange(n), counts)
        start = offsets[text] + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
        end = np.minimum(start + width, offsets[text + 1])
        # A product is at most the sum of its words' greatest parts; a squared norm is at least the sum of squared weights.
        some = np.flatnonzero(near[end] - near[start] >= 2)
        some = some[gain[end[some]] - gain[start[some]] >= (threshold - 1e-9) * np.sqrt(np.maximum(mass[end[some]] - mass[start[some]], 0))]
        for low in range(0, len(some), 2048):
            pick = some[low : low + 2048]
            place = start[pick][:, None] + np.arange(width)
            place = np.where(place < end[pick][:, None], place, len(hashes))
            row, known_ = words_[place], here[place]
            tf = ((row[:, :, None] == row[:, None, :]) & (place < len(hashes))[:, None, :]).sum(axis=2)
            squares = idf[place] ** 2 * tf
            dot = weight[term[place]].sum(axis=1)
            top = dot.argmax(axis=1)
            dot = dot[np.arange(len(pick)), top]
            value = dot / np.sqrt(np.maximum(squares.sum(axis=1), 1e-24))
            sure = known_.all(axis=1)
            for i in np.flatnonzero(value >= best[text[pick]] - 1e-12):
                t, v, k = text[pick[i]], value[i], top[i]
                if not sure[i]:
                    if v >= threshold - 1e-9:
                        _, first = np.unique(row[i], return_index=True)
                        others = [{"h": int(row[i, j].view(np.int64)), "tf": int(tf[i, j])} for j in first if not known_[i, j]]
                        open_[t].append((v, Window(float(dot[i]), int(k), float(squares[i][known_[i]].sum()), int(end[pick[i]] - start[pick[i]]), others)))
                elif v > best[t] + 1e-12 or (abs(v - best[t]) <= 1e-12 and v > 0 and k < which[t]):
                    best[t], which[t], length[t] = v, k, end[pick[i]] - start[pick[i]]
    return best, which, length, [[w for v, w in ws if v >= best[t] - 1e-12] for t, ws in enumerate(open_)]


OPEN = "array<struct<dot:double,which:int,norm2:double,words:int,others:array<struct<h:bigint,tf:int>>>>"


def own_licenses(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(id, path, is_license, license, score, share)`` of each file by its own text."""
    vocabulary, names, counts = template_words()
    frequencies = materialise(document_frequencies(files), "license-words")
    total = (frequencies.filter("h is null").first() or {"n": 0})["n"]
    known, complete = known_weights(frequencies, vocabulary, total)
    own = np.zeros(len(vocabulary))
    own[known.term[known.term < len(vocabulary)]] = known.idf[known.term < len(vocabulary)]
    unit = counts * own
    unit = unit / np.sqrt((unit**2).sum(axis=1, keepdims=True))
    widths = sorted({*WIDTHS, *counts.sum(axis=1).astype(int).tolist()})
    others = pa.list_(pa.struct([("h", pa.int64()), ("tf", pa.int32())]))
    kind = pa.list_(pa.struct([("dot", pa.float64()), ("which", pa.int32()), ("norm2", pa.float64()), ("words", pa.int32()), ("others", others)]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, offsets = word_hashes(batch.column("text"))
            best, which, length, more = best_windows(hashes, offsets, known, unit, widths, threshold)
            columns = [batch.column(c) for c in ("rid", "id", "path", "is_license")]
            rows = pa.array([[w._asdict() for w in ws] for ws in more], kind)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(which), pa.array(best), pa.array(length), pa.array(np.diff(offsets)), rows], ["rid", "id", "path", "is_license", "which", "score", "words", "size", "open"])

    schema = f"rid bigint, id bigint, path string, is_license boolean, which bigint, score double, words bigint, size bigint, open {OPEN}"
    held = materialise(files.select(F.monotonically_increasing_id().alias("rid"), "id", "path", "is_license", "text").mapInArrow(run, schema), "license-windows")
    score, which, length = F.col("score"), F.col("which"), F.col("words")
    if not complete:
        rare = held.select("rid", F.posexplode("open").alias("k", "w")).select("rid", "k", "w.dot", "w.which", "w.norm2", "w.words", F.inline("w.others"))
        weight = F.col("tf") * (F.log((1 + total) / (1 + F.col("n"))) + 1)
        norm2 = F.first("norm2") + F.sum(weight * weight * 1.0)
        cosines = rare.join(frequencies, "h").groupBy("rid", "k").agg((F.first("dot") / F.sqrt(norm2)).alias("s"), F.first("which").alias("t"), F.first("words").alias("w"))
        found = cosines.groupBy("rid").agg(F.min(F.struct((-F.round("s", 12)).alias("s"), "t", "w")).alias("x"))
        held = held.join(found, "rid", "left")
        s = -F.col("x.s")
        better = F.coalesce((s > score + 1e-12) | ((F.abs(s - score) <= 1e-12) & (F.col("x.t") < which)), F.lit(False))
        score, which, length = (F.when(better, x).otherwise(y) for x, y in ((s, score), (F.col("x.t"), which), (F.col("x.w"), length)))
    share = F.when(F.col("size") > 0, length / F.col("size")).otherwise(0.0)
    held = held.select("id", "path", "is_license", score.alias("score"), which.cast("int").alias("which"), share.alias("share"))
    license_ = F.when(F.col("score") >= threshold - 1e-12, F.get(F.array(*map(F.lit, names)), "which"))
    return held.select("id", "path", "is_license", license_.alias("license"), "score", "share")


def scan(files: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(id, path, license, score, origin, from_dir)`` of ``(id, path, text[, is_license])`` rows; origin is own, inherited or null."""
    bounded_batches(files.sparkSession)
    named = F.regexp_extract("path", r"([^/]*)$", 1).rlike(LICENSE_FILE)
    given = F.col("is_license") if "is_license" in files.columns else F.lit(None).cast("boolean")
    rows = files.select(F.col("id").cast("bigint").alias("id"), F.col("path").cast("string").alias("path"), "text", given.alias("is_license"))
    found = materialise(own_licenses(rows, threshold), "license-own")
    marked = F.coalesce("is_license", F.coalesce(named, F.lit(False)) | (F.col("share") >= LICENSE_SHARE))
    found = found.withColumn("is_license", marked)
    folder = F.when(F.col("path").contains("/"), F.regexp_replace("path", r"/[^/]*$", "")).when(F.col("path").isNotNull(), F.lit(""))
    found = found.withColumn("dir", folder)
    owned = found.filter(F.col("is_license") & F.col("license").isNotNull() & F.col("dir").isNotNull())
    owned = owned.groupBy("dir").agg(F.min(F.struct((-F.col("score")).alias("s"), "license")).alias("x")).select(F.col("dir").alias("above"), F.col("x.license").alias("theirs"))
    steps = F.split("dir", "/")
    above = F.transform(F.sequence(F.lit(0), F.size(steps)), lambda k: F.struct(k.alias("depth"), F.array_join(F.slice(steps, 1, k), "/").alias("above")))
    asked = found.filter(F.col("license").isNull() & F.col("dir").isNotNull()).select("dir").distinct()
    nearest = (
        asked.select("dir", F.inline(above)).join(owned, "above")
        .groupBy("dir").agg(F.max(F.struct("depth", "above", "theirs")).alias("x"))
        .select("dir", F.col("x.above").alias("from_dir"), F.col("x.theirs").alias("theirs"))
    )
    # Written, so that Spark knows whether it may be broadcast: files of one folder may be very many.
    nearest = materialise(nearest, "license-nearest")
    # Only files that have a folder and no license of their own can inherit; the others are not shuffled.
    heir = F.col("license").isNull() & F.col("dir").isNotNull()
    joined = found.filter(heir).join(nearest, "dir", "left").unionByName(found.filter(~heir), allowMissingColumns=True)
    own = F.col("license").isNotNull()
    return joined.select(
        "id", "path", F.coalesce("license", "theirs").alias("license"), "score",
        F.when(own, "own").when(F.col("theirs").isNotNull(), "inherited").alias("origin"),
        F.when(~own, F.col("from_dir")).alias("from_dir"),
    )
