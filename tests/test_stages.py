"""Stages kept between queries follow their input files; a scope removes its own folders."""

import os

import pytest
from pyspark.sql import functions as F

from orderloom.plans.stages import stage
from orderloom.session import materialise, shared_dir, stage_scope


def test_changed_files_give_a_new_answer(spark, tmp_path):
    built = []

    @stage
    def rows(spark, folder):
        built.append(folder)
        return spark.read.parquet(f"{folder}/t").count()

    folder = str(tmp_path)
    spark.range(3).write.parquet(f"{folder}/t")
    assert (rows(spark, folder), rows(spark, folder)) == (3, 3) and len(built) == 1
    spark.range(4).write.mode("append").parquet(f"{folder}/t")
    assert rows(spark, folder) == 7 and len(built) == 2


def test_scope_removes_its_own_folders_only(spark):
    kept = materialise(spark.range(3), "kept")
    result = shared_dir(spark, "result")
    with pytest.raises(ValueError), stage_scope(spark):
        inner = materialise(kept.withColumn("x", F.col("id") * 2), "inner")
        files = inner.inputFiles()
        out = materialise(inner.where("x > 0"), "result", result)
        raise ValueError
    assert out.count() == 2 and kept.count() == 3
    assert files and not any(os.path.exists(f.removeprefix("file://")) for f in files)
