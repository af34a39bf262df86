"""Corpus preparation: language ID, near duplicates, benchmark decontamination, secrets, mixing.

Each stage works on all that the one before kept and returns the columns of ``documents``; the last adds what the mix takes.  ``run``
writes each stage's result as Parquet to the shared folder and reads it back for the next; what a stage itself wrote on the way is removed
once its result is there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from orderloom.llm import decontam, jaccard, lang_id, mixing, secrets
from orderloom.llm.shared import bounded_batches, read_table
from orderloom.session import materialise, shared_dir, stage_scope


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an accepted language go."""
    bounded_batches(spark)
    return lang_id.keep_identified(docs)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays."""
    bounded_batches(spark)
    return jaccard.keep_one(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced by a mark; all documents stay."""
    return secrets.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the mix takes from, with size, source_size, target and the words taken (repeats counted)."""
    return mixing.take(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("secrets", redact_secrets),
    ("mixing", mix),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        result = shared_dir(spark, name)
        with stage_scope(spark):
            docs = materialise(stage(spark, docs, sf_dir), name, result)
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL cannot express the stages; the tests hold each against a brute-force version.
ORACLE_SQL = None
