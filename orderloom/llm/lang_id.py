"""Language ID by Bayesian evidence fusion.

Evidence of a document: its text (naive Bayes over hashed byte n-grams), the language its markup or metadata declares, the
suffix of its address, and its host.  The posterior is proportional to

    P(text | l) ** DAMPING * P(declared | l) * P(suffix | l) * P(l | host)

The text model is fitted on a documented bounded sample (``TRAIN_DOCS``) of the rows that declare a language; everything else
- how reliable declarations are, suffixes by language, host priors smoothed towards their suffix and that towards the whole
corpus - is counted by grouped aggregation over all rows.  The unknown language ``und`` has flat grams and the prior
``UNKNOWN_PRIOR`` in every host, whatever the sizes of table and host, as no row is counted for it; a document that it
wins, or without letters, or whose best language stays below ``LEAST`` is rejected.

Scale: text is read twice (fit, score) and never shuffled; later steps handle narrow rows.  Host priors are one row per
host and language and joined by host; one host may own most rows (partial aggregation, AQE splits the join).

Defined cases: null or empty text has no grams and is rejected; null hosts and declarations are evidence for nothing; equal
rows get equal results; the result has one row per input row; an empty table gives an empty result.  A tie goes to
the language first by name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import bounded_batches, row_key
from orderloom.session import materialise

BINS = 1 << 15
GRAM = 4
#: At most about this many rows fit the text model; other rows are counted in all other statistics.
TRAIN_DOCS = 20_000
DAMPING = 0.2
#: Pseudo-rows of the parent distribution in a host's or a suffix's own counts.
HOST_WEIGHT = 20.0
LEAST = 0.5
LANGUAGE = r"^\s*([A-Za-z]{2,3})(?:[-_].*)?\s*$"
UNKNOWN = "und"
#: Prior of the unknown language in any table and host.
UNKNOWN_PRIOR = 1e-3


def gram_bins(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hash bins of the byte ``GRAM``-grams of all texts in a row, and the texts' offsets.

    Runs of anything but letters and marks count as one blank, and a text starts and ends with a blank.
    """
    clean = pc.replace_substring_regex(pc.utf8_lower(pc.fill_null(texts.cast(pa.string()), "")), r"[^\pL\pM]+", " ")
    clean = pc.binary_join_element_wise(" ", pc.utf8_trim(clean, " "), " ", "")
    lengths = pc.binary_length(clean).to_numpy().astype(np.int64)
    data = np.frombuffer(b"".join(clean.cast(pa.binary()).to_pylist()), np.uint8).astype(np.uint32)
    # A text of blanks only has no grams.
    counts = np.where(lengths > 2, np.maximum(lengths - GRAM + 1, 0), 0)
    starts = np.concatenate([[0], np.cumsum(lengths)])
    offsets = np.concatenate([[0], np.cumsum(counts)])
    at = np.repeat(starts[:-1] - offsets[:-1], counts) + np.arange(offsets[-1])
    code = np.zeros(len(at), np.uint32)
    for j in range(GRAM):
        code |= data[at + j] << np.uint32(8 * j)
    return ((code * np.uint32(2654435761)) >> np.uint32(32 - 15)).astype(np.int64), offsets


def declared_language(column: Column) -> Column:
    """Primary subtag of a declared language, lower case; null if it has none."""
    tag = F.lower(F.regexp_extract(column, LANGUAGE, 1))
    return F.when(tag != "", tag)


def markup_language(text: Column) -> Column:
    """What ``<html lang=...>`` declares, else null."""
    tag = F.regexp_extract(text, r"""(?i)<html[^>]{0,500}\slang\s{0,9}=\s{0,9}["']?([A-Za-z]{2,3})""", 1)
    return F.when(tag != "", F.lower(tag))


def evidence(docs: DataFrame, text: str = "text", declared: str = "lang", host: str = "source") -> DataFrame:
    """``(doc_id, key, text, declared, host, suffix)``: markup goes before metadata; the suffix ends a dotted host."""
    address = F.lower(F.regexp_replace(F.col(host), r"^[a-z]+://|[/:?#].*$", ""))
    suffix = F.regexp_extract(address, r"\.([a-z]{2,3})$", 1)
    return docs.select(
        "doc_id",
        row_key(F.col("doc_id"), F.col(text)).alias("key"),
        F.col(text).alias("text"),
        F.coalesce(markup_language(F.col(text)), declared_language(F.col(declared))).alias("declared"),
        address.alias("host"),
        F.when(suffix != "", suffix).alias("suffix"),
    )


def fit(rows: DataFrame, train_docs: int = TRAIN_DOCS) -> tuple[list[str], np.ndarray]:
    """Languages and their log-probabilities of the gram bins, fitted on a hash sample of declared rows."""
    known = rows.filter(F.col("declared").isNotNull())
    every = max(1, -(-known.count() // train_docs))
    sample = known.filter(F.pmod(F.xxhash64("key"), F.lit(every)) == 0).select("text", "declared")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            bins, offsets = gram_bins(batch.column(0))
            owner = np.array(batch.column(1).to_pylist())
            of = np.repeat(owner, np.diff(offsets))
            for lang in set(owner):
                total[lang] = total.get(lang, 0) + np.bincount(bins[of == lang], minlength=BINS)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(n[at])], ["lang", "bin", "n"])

    counted = sample.mapInArrow(count, "lang string, bin bigint, n bigint").groupBy("lang", "bin").agg(F.sum("n").alias("n"))
    model = counted.toArrow()  # at most languages * BINS rows
    names = sorted(set(model.column("lang").to_pylist()))
    n = np.full((len(names), BINS), 0.1)
    place = {name: i for i, name in enumerate(names)}
    n[[place[x] for x in model.column("lang").to_pylist()], model.column("bin").to_numpy()] += model.column("n").to_numpy()
    return names, np.log(n / n.sum(axis=1, keepdims=True))


def score(rows: DataFrame, names: list[str], log_p: np.ndarray) -> DataFrame:
    """All rows without their text: damped log-likelihoods per language (the last one is ``und``), and the text's language."""
    flat = math.log(1 / BINS)
    weights = log_p.astype(np.float32)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins, offsets = gram_bins(batch.column("text"))
            full = np.diff(offsets) > 0
            out = np.zeros((len(full), len(names) + 1))
            for i in range(len(names)):
                if full.any():
                    out[full, i] = np.add.reduceat(weights[i][bins], offsets[:-1][full], dtype=np.float64)
            out[:, -1] = np.diff(offsets) * flat
            out *= DAMPING
            best = pa.array([names[i] if f and names else None for i, f in zip(out[:, :-1].argmax(axis=1) if names else full, full, strict=True)], pa.string())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(full) + 1, dtype=np.int32) * (len(names) + 1)), pa.array(out.ravel()))
            arrays = [batch.column(c) for c in ("doc_id", "key", "declared", "host", "suffix")]
            yield pa.RecordBatch.from_arrays(
                [*arrays, pa.array(np.diff(offsets)), best, lists], ["doc_id", "key", "declared", "host", "suffix", "grams", "text_lang", "scores"]
            )

    ident = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {ident}, key string, declared string, host string, suffix string, grams bigint, text_lang string, scores array<double>"
    return rows.mapInArrow(run, schema)


def identify(docs: DataFrame, least: float = LEAST, train_docs: int = TRAIN_DOCS, **columns: str) -> DataFrame:
    """``(doc_id, key, lang, posterior, text_lang, declared, accepted)`` of every row."""
    bounded_batches(docs.sparkSession)
    rows = evidence(docs, **columns)
    names, log_p = fit(rows, train_docs)
    scored = materialise(score(rows, names, log_p), "lang-scores")
    seen = scored.filter(F.col("text_lang").isNotNull())
    all_names = [*names, UNKNOWN]

    def table(by: str) -> dict[str, dict[str, int]]:
        """Counts of text language by a column of few values (languages or suffixes)."""
        out: dict[str, dict[str, int]] = {}
        for r in seen.filter(F.col(by).isNotNull()).groupBy("text_lang", by).count().collect():
            out.setdefault(r[by], {})[r["text_lang"]] = r["count"]
        return out

    declared, suffix = table("declared"), table("suffix")
    total = {r["text_lang"]: r["count"] for r in seen.groupBy("text_lang").count().collect()}
    everything = sum(total.values())
    share = [(total.get(l, 0) + 1) / (everything + len(names)) for l in names]

    def likelihood(counts: dict[str, dict[str, int]]) -> dict[str, list[float]]:
        """log P(value | language), smoothed by one row."""
        return {v: [math.log((n.get(l, 0) + 1 / (len(counts) + 1)) / (total.get(l, 0) + 1)) for l in all_names] for v, n in counts.items()}

    def looked_up(column: str, logs: dict[str, list[float]]) -> Column:
        zero = F.array(*[F.lit(0.0)] * len(all_names))
        if not logs:
            return zero
        entries = [x for v, row in logs.items() for x in (F.lit(v), F.array(*map(F.lit, row)))]
        return F.coalesce(F.try_element_at(F.create_map(*entries), F.col(column)), zero)

    # P(l | suffix) leans on the corpus, P(l | host) on the host's suffix.
    def parent(s: str | None) -> list[float]:
        n = suffix.get(s, {})
        size = sum(n.values())
        return [(n.get(l, 0) + HOST_WEIGHT * p) / (size + HOST_WEIGHT) for l, p in zip(names, share, strict=True)]

    parents = [x for s in suffix for x in (F.lit(s), F.array(*map(F.lit, parent(s))))]
    corpus = F.array(*map(F.lit, parent(None))) if names else F.array().cast("array<double>")
    above = F.coalesce(F.try_element_at(F.create_map(*parents), F.col("suffix")), corpus) if parents else corpus
    by_host = (
        seen.filter(F.col("host").isNotNull())
        .groupBy("host", "text_lang").agg(F.count("*").alias("n"))
        .groupBy("host").agg(F.map_from_entries(F.collect_list(F.struct("text_lang", "n"))).alias("n"), F.sum("n").alias("size"))
    )
    own = lambda l: F.coalesce(F.try_element_at(F.col("n"), F.lit(l)), F.lit(0))
    prior = F.array(
        *(
            math.log(1 - UNKNOWN_PRIOR) + F.log((own(l) + HOST_WEIGHT * F.get(F.col("above"), i)) / (F.coalesce("size", F.lit(0)) + HOST_WEIGHT))
            for i, l in enumerate(names)
        ),
        F.lit(math.log(UNKNOWN_PRIOR)),
    )
    fused = scored.select("*", above.alias("above")).join(by_host, "host", "left")
    add = lambda a, b: F.zip_with(a, b, lambda x, y: x + y)
    log_post = add(add(F.col("scores"), looked_up("declared", likelihood(declared))), add(looked_up("suffix", likelihood(suffix)), prior))
    fused = fused.select("doc_id", "key", "grams", "declared", "text_lang", log_post.alias("lp"))
    fused = fused.withColumn("top", F.array_max("lp"))
    mass = F.aggregate("lp", F.lit(0.0), lambda s, x: s + F.exp(x - F.col("top")))
    name = F.array(*map(F.lit, all_names))
    lang = F.get(name, (F.array_position("lp", F.col("top")) - 1).cast("int"))
    fused = fused.select("doc_id", "key", "grams", lang.alias("lang"), (1 / mass).alias("posterior"), "text_lang", "declared")
    good = (F.col("grams") > 0) & (F.col("lang") != UNKNOWN) & (F.col("posterior") >= least)
    return fused.select("doc_id", "key", "lang", "posterior", "text_lang", "declared", good.alias("accepted"))


def keep_identified(docs: DataFrame, **how) -> DataFrame:
    """The documents without those that are rejected; rows and columns otherwise as they are."""
    decided = identify(docs, **how)
    rejected = decided.filter(~F.col("accepted")).select(F.col("key").alias("__key")).distinct()
    return docs.join(rejected, row_key(docs["doc_id"], docs["text"]) == F.col("__key"), "left_anti")
