"""Queries of the operators: each applies one to its whole intended table and returns its full result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom.llm import (
    checks, decontam, importance, jaccard, lang_id, licenses, merkle, mixing, pii, secrets, suffix_dedup, url_filter, vptree, warc,
)
from orderloom.llm.shared import read_table
from orderloom.session import shared_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_warc_writer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each record says; the file it lies in is left out, as it has no counterpart in SQL."""
    return warc.round_trip(read_table(spark, sf_dir, "pages"), shared_dir(spark, "warc")).drop("file")


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(read_table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "score", "question_overlap", "answer_overlap")


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.digest(read_table(spark, sf_dir, "documents"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.deduplicate(read_table(spark, sf_dir, "documents"), keep_bytes=False)


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(read_table(spark, sf_dir, "documents"))


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(read_table(spark, sf_dir, "documents"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, which have no path, by their own text; pages as files of their host's directories, by their visible text."""
    docs = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), F.lit(None).cast("string").alias("path"), "text")
    path = F.regexp_replace("url", r"^[A-Za-z]+://|[?#].*$", "")
    shown = F.regexp_replace("html", r"(?is)<(script|style)\b.*?</\1\s*>|<[^>]*>|&#?\w+;", " ")
    pages = read_table(spark, sf_dir, "pages").select(F.col("page_id").alias("id"), path.alias("path"), shown.alias("text"))
    found = [licenses.scan(files).select(F.lit(name).alias("table"), "*") for name, files in (("documents", docs), ("pages", pages))]
    return found[0].unionByName(found[1]).withColumnRenamed("id", "doc_id")


def op9_vp_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vptree.search(read_table(spark, sf_dir, "embeddings"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lang_id.identify(read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "lang", "posterior", "text_lang", "declared", "accepted")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(read_table(spark, sf_dir, "documents"))


def op12_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.verdicts(read_table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_warc_writer, op2_pii, op3_decontamination, op4_mixing, op5_suffix_dedup, op6_secrets, op7_jaccard_join,
        op8_license_scan, op9_vp_trees, op10_language_id, op11_merkle_manifest, op12_importance_resampling, op13_url_filter,
    )
}

#: SQL that another engine can run on the same tables; the other queries are tested against brute force.
CHECKS: dict[str, str] = checks.CHECKS
