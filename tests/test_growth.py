"""What must not grow faster than the input: caches, sorts of wide rows, work that a query does not need."""

import os
import time

import pytest
from pyspark.sql import functions as F

from orderloom import schemas, session
from orderloom.ml import models, prep, splits
from orderloom.operators import clean as cleaning
from orderloom.operators import ranks
from orderloom.plans import catalog_models, frames
from orderloom.plans.catalog import QUERIES
from orderloom.sources import snapshots
from orderloom.streaming import scoring

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_log_is_deduplicated_before_it_is_joined(spark):
    text = plan(frames.dedup(spark, SF))
    assert text.index("Join") < text.index("WindowGroupLimit") < text.index("Partial")


def test_clean_set_is_not_written_again(spark):
    assert frames.clean_table(spark, SF).inputFiles() == frames.dedup_table(spark, SF).inputFiles()


def test_found_values_fill_like_subqueries(spark, as_rows):
    rows = frames.dedup_table(spark, SF)
    assert as_rows(cleaning.impute(rows)) == as_rows(cleaning.impute(rows, cleaning.imputation(rows)))


def test_small_fits_train_no_full_model(spark, monkeypatch):
    def fail(*_):
        raise AssertionError("a full model was trained")

    monkeypatch.setattr(catalog_models, "return_run", fail)
    monkeypatch.setattr(catalog_models, "basket_run", fail)
    assert QUERIES["linear_two_features"](spark, SF).count() == 3
    assert QUERIES["logistic_one_indicator"](spark, SF).count() == 1


def test_pieces_that_tasks_read_are_limited(spark):
    key, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for given, wanted in (("128MB", session.READ_PIECE), ("1g", session.READ_PIECE), ("16m", 16 << 20)):
            spark.conf.set(key, given)
            assert session._bytes(session.configure(spark).conf.get(key)) == wanted
    finally:
        spark.conf.set(key, before)


def test_buckets_are_merged_in_slices(spark, tmp_path):
    root, parts = str(tmp_path), spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        snapshots.upsert(spark, root, {"data": snapshots.Batch(spark.range(1000).select(F.col("id").alias("k")), "k")}, buckets=1)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", parts)
    found = snapshots.read(spark, root)
    assert found.count() == found.distinct().count() == 1000
    assert len(found.inputFiles()) > 1


def test_batches_are_not_cached(spark, tmp_path, monkeypatch):
    def fail(*_):
        raise AssertionError("a batch was cached")

    monkeypatch.setattr(type(spark.range(1)), "persist", fail)
    monkeypatch.setattr(scoring, "score_returns", lambda pipeline, rows: rows.withColumn("return_proba", F.lit(0.5)))
    good = '{"event_id": "%s", "order_id": "o", "customer_customer_id": "c"}'
    lines = [(good % "a", "2026-01-01"), (good % "a", "2026-01-02"), (good % "b", "2026-01-01"), ("bad", "2026-01-01"), (" ", "2026-01-01")]
    batch = spark.createDataFrame(lines, "value string, t string").select("value", F.col("t").cast("timestamp").alias("broker_time"))
    job = scoring.ScoringJob(str(tmp_path), None, id_buckets=4)
    for number in (0, 1):
        job(batch, number)
    ids = {(r["batch_id"], r["event_id"]) for r in scoring.read_log(spark, str(tmp_path), scoring.ACCEPTED).collect()}
    assert ids == {(0, "a"), (0, "b")}
    reasons = sorted(r["reason"] for r in scoring.read_log(spark, str(tmp_path), scoring.REJECTED).where("batch_id = 1").collect())
    assert reasons == ["blank line", "invalid JSON"]
    sent = scoring.read_log(spark, str(tmp_path), scoring.INTAKE).where("batch_id = 0").first()
    assert (sent["sent"], sent["skipped_empty"], sent["skipped_invalid_json"], sent["refused"], sent["good"]) == (3, 1, 1, 0, 3)


def many_values(spark):
    """Continuous, skewed, whole-numbered, mostly one value, with gaps and NaN, constant, and empty."""
    i = F.col("id")
    return spark.range(30000).select(
        F.pow(F.rand(3) * 10 + 1, F.lit(6.0)).alias("a"), (-F.log(F.rand(4))).alias("b"), (i % 7).alias("c"),
        F.when(i % 3 == 0, F.rand(5)).otherwise(-0.0).alias("d"), F.when(i % 5 == 0, F.lit(None)).when(i % 11 == 0, F.lit(float("nan"))).otherwise(F.rand(6)).alias("e"),
        F.lit(4.0).alias("f"), F.lit(None).cast("double").alias("g"), F.when(i < 5, i.cast("double")).alias("h"),
    )


def wanted_points(df, probs):
    points = {}
    for r in ranks.quantile_points(df, df.columns, probs).collect():
        points.setdefault(r["column"], (r["total"], {}))[1][r["prob"]] = (r["low"], r["high"], r["part"])
    return points


@pytest.mark.parametrize("reach", [0.01, 0.0, 0.3])
def test_bracketed_ranks_are_exact(spark, monkeypatch, reach):
    probs = [0.0, 0.25, 0.5, 0.75, 0.999, 1.0]
    df = session.materialise(many_values(spark), "values")
    monkeypatch.setattr(ranks, "SKETCH_REACH", reach)
    assert ranks.found_points(df, df.columns, probs) == wanted_points(df, probs)


def test_preparation_makes_no_row_of_every_value(spark, monkeypatch):
    df = session.materialise(many_values(spark).select("a", "b", "c", "d", "f"), "values")
    expected = prep.spreads(df, df.columns)

    def fail(*_, **__):
        raise AssertionError("every value became a row")

    monkeypatch.setattr(ranks, "order_statistics", fail)
    assert prep.spreads(df, df.columns) == expected


@pytest.mark.parametrize("share", [0.0, 0.2, 0.5, 1.0])
def test_split_converts_no_hash_and_cuts_at_the_same_one(spark, share):
    df = spark.range(6000).select(F.col("id").cast("string").alias("event_id"), F.when(F.col("id") % 3 > 0, F.col("id") % 3 == 1).alias("y"))
    marked = splits.stratified_split(df, "event_id", "y", test_share=share)
    assert "conv(" not in plan(marked)
    sides = {}
    for r in marked.withColumn("h", splits.unit_hash(F.col("event_id"), 42)).collect():
        sides.setdefault(r["y"], []).append((r["h"], r["is_test"]))
    assert len(sides) == 3
    for rows in sides.values():
        take = min(round(len(rows) * share), len(rows) - 1)
        assert [t for _, t in sorted(rows)] == [k < take for k in range(len(rows))]


def messages_of(spark, lines):
    text = '{"event_id": "%s", "order_id": "o-%s", "customer_customer_id": "c", "order_basket_value": %d}'
    rows = [(text % (e, e, v), t) for e, t, v in lines] + [("bad", "2026-01-01")]
    return spark.createDataFrame(rows, "value string, t string").select("value", F.col("t").cast("timestamp").alias("broker_time"))


def test_a_batch_in_parts_is_the_batch_at_once(spark, tmp_path, monkeypatch, as_rows):
    """Copies of an event meet whatever the parts; an attempt that is made again replaces all parts of the first."""
    monkeypatch.setattr(scoring, "score_returns", lambda pipeline, rows: rows.withColumn("return_proba", F.lit(0.5)))
    first = [(f"e{i % 40}", f"2026-01-0{1 + i % 3}", i) for i in range(100)]
    second = [(f"e{i % 60}", "2026-02-01", i) for i in range(90)]
    found = {}
    for size in (7, 10**6):
        monkeypatch.setattr(scoring, "PART_ROWS", size)
        root = str(tmp_path / str(size))
        job = scoring.ScoringJob(root, None, id_buckets=4)
        job(messages_of(spark, second), 0)
        job(messages_of(spark, first), 0)
        job(messages_of(spark, second), 1)
        found[size] = {name: as_rows(scoring.read_log(spark, root, name)) for name in (scoring.ACCEPTED, scoring.REJECTED, scoring.PREDICTIONS, scoring.INTAKE)}
    assert found[7] == found[10**6]
    kept = {r[0]: r[-1] for r in found[7][scoring.ACCEPTED]}
    assert kept == {f"e{i}": int(i >= 40) for i in range(60)} and len(found[7][scoring.ACCEPTED]) == 60


def shuffle_blocks(spark):
    blocks = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {str(blocks.apply(i).getName()) for i in range(blocks.size()) if blocks.apply(i).getName().startswith("shuffle_")}


def test_shuffles_go_with_their_write(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scoring, "score_returns", lambda pipeline, rows: rows.withColumn("return_proba", F.lit(0.5)))
    batch = messages_of(spark, [(f"e{i % 40}", "2026-01-01", i) for i in range(100)])
    setting = next(iter(session.DROP_SHUFFLES))
    before, conf = shuffle_blocks(spark), spark.conf.get(setting)
    written = session.materialise(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    scoring.ScoringJob(str(tmp_path / "out"), None, id_buckets=4)(batch, 0)
    for _ in range(40):  # the files are removed in the background
        left = shuffle_blocks(spark) - before
        if not left:
            break
        time.sleep(0.25)
    assert not left and spark.conf.get(setting) == conf
    assert written.count() == 7


def order_rows(spark):
    i = F.col("id")
    typed = {"string": F.concat(F.lit("v"), i % 3), "timestamp": F.lit("2026-01-02").cast("timestamp"), "boolean": i % 2 == 0}
    values = {f.name: typed.get(f.dataType.simpleString(), (i % 13 + 1).cast(f.dataType)) for f in schemas.EVENT.fields}
    values["event_id"] = F.concat(F.lit("e"), i)
    return spark.range(80).select(*[v.alias(name) for name, v in values.items()])


def test_training_for_scores_alone_leaves_no_table(spark, tmp_path, monkeypatch):
    folders = []
    monkeypatch.setattr(frames, "dedup", lambda *_: order_rows(spark))
    monkeypatch.setattr(session, "shared_dir", lambda s, purpose, real=session.shared_dir: folders.append(real(s, purpose)) or folders[-1])
    pipeline = catalog_models.return_pipeline(spark, str(tmp_path))
    assert len(folders) >= 3 and not any(os.path.exists(f) for f in folders)
    assert models.score_returns(pipeline, frames._cleaned(order_rows(spark))).count() == 80
    # A run that is kept is taken as it is.
    (tmp_path / "x").touch()
    run = catalog_models.return_run(spark, str(tmp_path))
    assert catalog_models.return_pipeline(spark, str(tmp_path)) is run.pipeline
