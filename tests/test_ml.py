"""Splits, preparation, models and metrics."""

import math
import random

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.ml import metrics, models, prep, splits


def scored(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "label int, score double")


def test_all_negative_predictions(spark):
    """632 negatives and 168 positives, every one predicted negative."""
    df = scored(spark, [(0, 0.1)] * 632 + [(1, 0.1)] * 168)
    m = metrics.threshold_metrics(df, "label", "score").first().asDict()
    assert m == {
        "accuracy": 0.79, "precision": 0.0, "recall": 0.0, "f1": 0.0, "balanced_accuracy": 0.5, "matthews_corrcoef": 0.0,
    }
    assert tuple(metrics.confusion(df, "label", "score").first()) == (632, 0, 168, 0)
    report = {r["class"]: r for r in metrics.classification_report(df, "label", "score").collect()}
    assert report["0"]["f1_score"] == pytest.approx(0.88268156424581)
    assert report["macro avg"]["f1_score"] == pytest.approx(0.441340782122905)
    assert report["weighted avg"]["precision"] == pytest.approx(0.6241)
    assert report["weighted avg"]["f1_score"] == pytest.approx(0.69731843575419)
    assert report["accuracy"]["support"] == 800.0


def brute_auc(pairs):
    pos = [s for y, s in pairs if y]
    neg = [s for y, s in pairs if not y]
    return sum((p > n) + (p == n) / 2 for p in pos for n in neg) / (len(pos) * len(neg))


def brute_ap(pairs):
    total = sum(y for y, _ in pairs)
    out = 0.0
    for s in sorted({s for _, s in pairs}, reverse=True):
        above = [y for y, x in pairs if x >= s]
        out += sum(y for y, x in pairs if x == s) / total * sum(above) / len(above)
    return out


@pytest.mark.parametrize("digits", [1, 9])
def test_ranking_metrics_against_brute_force(spark, digits):
    rng = random.Random(digits)
    pairs = [(rng.random() < 0.3, round(rng.random(), digits)) for _ in range(300)]
    row = metrics.ranking_metrics(scored(spark, pairs), "label", "score").first()
    assert row["roc_auc"] == pytest.approx(brute_auc(pairs)) and row["pr_auc"] == pytest.approx(brute_ap(pairs))
    best = metrics.best_threshold(scored(spark, pairs), "label", "score").first()
    f1 = lambda t: 2 * sum(y for y, s in pairs if s >= t) / (sum(s >= t for _, s in pairs) + sum(y for y, _ in pairs))
    assert best["f1"] == pytest.approx(max(f1(s) for _, s in pairs))


def test_single_class(spark):
    row = metrics.classification_metrics(scored(spark, [(0, 0.2), (0, 0.9)]), "label", "score").first()
    assert row["roc_auc"] is None and row["pr_auc"] is None and row["accuracy"] == 0.5
    assert metrics.ranking_metrics(scored(spark, [(1, 0.2), (1, 0.9)]), "label", "score").first()["roc_auc"] is None


def test_losses(spark):
    row = metrics.probability_losses(scored(spark, [(1, 0.8), (0, 0.4), (1, 1.0), (0, 0.0)]), "label", "score").first()
    assert row["log_loss"] == pytest.approx(-(math.log(0.8) + math.log(0.6)) / 4)
    assert row["brier_score"] == pytest.approx((0.04 + 0.16) / 4)


def test_regression_metrics(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 2.0), (4.0, 3.0)], "y double, p double")
    m = metrics.regression_metrics(df, "y", "p").first()
    assert m["mae"] == pytest.approx(2 / 3) and m["mape"] == pytest.approx((1 + 0 + 0.25) / 3)
    assert m["r2"] == pytest.approx(1 - 2 / (14 / 3))
    r = metrics.residual_summary(df, "y", "p").first()
    assert (r["mean"], r["min_value"], r["max_value"]) == (0.0, -1.0, 1.0)
    assert r["std"] == pytest.approx(math.sqrt(2 / 3))


def test_split_is_disjoint_complete_and_stable(spark, as_rows):
    df = spark.range(1000).select(F.col("id").cast("string").alias("event_id"), (F.col("id") % 5 == 0).alias("y"))
    once = splits.stratified_split(df, "event_id", "y")
    sizes = {(r["y"], r["is_test"]): r["count"] for r in once.groupBy("y", "is_test").count().collect()}
    assert sizes == {(True, True): 40, (True, False): 160, (False, True): 160, (False, False): 640}
    assert as_rows(splits.stratified_split(df.repartition(7), "event_id", "y")) == as_rows(once)
    random_split = splits.random_split(df, "event_id")
    assert random_split.count() == 1000
    assert 150 < random_split.where("is_test").count() < 250
    other = splits.random_split(df, "event_id", seed=7)
    assert as_rows(random_split) != as_rows(other)


def test_iqr_clipper(spark, tmp_path, as_rows):
    df = spark.createDataFrame([(1.0, 0.0), (2.0, 0.0), (3.0, 0.0), (4.0, 0.0), (100.0, 9.0), (None, None)], "x double, z double")
    model = prep.IqrClipper(inputCols=["x", "z"]).fit(df)
    got = as_rows(model.transform(df))
    # Q1 = 2 and Q3 = 4 for x; z has no spread and is clipped to a constant.
    assert (7.0, 0.0) in got and (None, None) in got and len(got) == 6
    path = str(tmp_path / "clipper")
    model.write().save(path)
    assert as_rows(prep.IqrClipperModel.load(path).transform(df)) == got


def test_scales(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (10.0, 5.0)], "x double, c double")
    assert prep.robust_scales(df, ["x", "c"]) == {"x": [2.5, 4.75 - 1.75], "c": [5.0, 1.0]}
    standard = prep.standard_scales(df, ["x", "c"])
    assert standard["x"] == [4.0, pytest.approx(math.sqrt(12.5))] and standard["c"] == [5.0, 1.0]


def test_one_hot_unseen_and_missing(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), (None,)], "s string")
    values = prep.categories(df, ["s"])
    assert values == {"s": ["a", "b", "c"]}
    other = spark.createDataFrame([("c",), ("zzz",), (None,)], "s string")
    assert [tuple(r) for r in prep.one_hot(other, values).collect()] == [(0.0, 1.0), (0.0, 0.0), (0.0, 0.0)]


def test_many_categories(spark):
    df = spark.range(2500).select(F.format_string("v%04d", "id").alias("s"))
    values = prep.categories(df, ["s"])
    assert len(values["s"]) == 2500 and values["s"][:2] == ["v0000", "v0001"]


def clean_rows(spark, n=400, seed=1):
    rng = random.Random(seed)
    data = []
    for i in range(n):
        category, basket = rng.choice(["fashion", "home", "books"]), round(rng.uniform(10, 500), 2)
        fee, items = (0.0 if basket > 80 else 5.0), rng.randint(1, 8)
        returned = rng.random() < (0.8 if category == "fashion" else 0.1)
        data.append((
            f"E{i}", f"O{i}", f"C{i % 40}", rng.choice(["FR", "DE", "IT"]), rng.choice(["mobile", "desktop"]),
            rng.choice(["seo", "ads", None]), category, items, basket, fee, rng.choice([0.0, 3.0, None]),
            basket + fee, returned, 2026, 1, rng.randint(1, 28), rng.randint(0, 23), basket / items,
        ))
    fields = (
        "event_id string, order_id string, customer_customer_id string, customer_country string, order_device string, "
        "order_channel string, order_main_category string, order_n_items long, order_basket_value double, "
        "order_shipping_fee double, order_discount double, order_order_total double, order_is_returned boolean, "
        "event_year int, event_month int, event_day int, event_hour int, price_average_per_item double"
    )
    return spark.createDataFrame(data, fields)


@pytest.fixture(scope="module")
def trained(spark):
    return models.train_return_model(clean_rows(spark))


def test_return_model_learns_and_survives_saving(spark, trained, tmp_path, as_rows):
    s = models.score_returns(trained.pipeline, trained.test, keep=["event_id", F.col("order_is_returned").cast("int").alias("label")])
    m = metrics.classification_metrics(s, "label", "return_proba").first()
    assert m["accuracy"] > 0.75 and m["roc_auc"] > 0.75
    coefs = models.coefficients(spark, trained.pipeline, trained.features)
    top = models.top_coefficients(coefs, 1).where("side = 'positive'").first()
    assert top["feature"] == "order_main_category_fashion"
    path = str(tmp_path / "bundle")
    models.save_bundle(trained.pipeline, path)
    loaded = models.load_bundle(spark, path)
    assert as_rows(models.score_returns(loaded, trained.test)) == as_rows(models.score_returns(trained.pipeline, trained.test))
    bare = str(tmp_path / "bare")
    trained.pipeline.stages[-1].write().save(bare)
    assert len(models.load_bundle(spark, bare).stages) == 1


def test_serving_rows_get_the_training_columns(spark, trained):
    raw = clean_rows(spark, 5, seed=9).select("event_id", *[c for c in schemas.MODEL_FEATURES if c != "order_channel"])
    unseen = raw.withColumn("order_device", F.lit("fridge")).withColumn("extra", F.lit(1))
    out = trained.pipeline.stages[0].transform(unseen)
    assert out.columns == ["event_id", "extra", *trained.features]
    row = out.first()
    assert row["order_device_mobile"] == 0.0 and row["order_channel_seo"] == 0.0
    audit = prep.feature_audit(trained.pipeline.stages[0].transform(trained.train), trained.pipeline.stages[0].transform(trained.test), trained.features)
    for r in audit.collect():
        assert r["n_missing"] == 0 and r["same_columns"] and r["n_constant"] >= 2


def test_excluded_columns_and_weights(spark):
    run = models.train_return_model(clean_rows(spark), exclude=["order_order_total"], class_weights=True)
    assert "order_order_total" not in run.features
    assert isinstance(run.pipeline, PipelineModel)


def test_basket_model_and_reports(spark, trained):
    run = models.train_basket_model(clean_rows(spark))
    doc = models.basket_model_report(spark, run).first()
    assert doc["metrics"]["r2"] > 0.99 and doc["train_rows"] + doc["test_rows"] == 400
    doc = models.return_model_report(spark, trained).first()
    assert doc["n_features"] == len(trained.features) == len(doc["feature_names"])
    assert len(doc["classification_report"]) == 5 and doc["run_id"]
    assert doc["confusion_matrix"]["tn"] + doc["confusion_matrix"]["fp"] > 0


def test_stored_run(spark, trained, tmp_path, as_rows):
    """Feature sets, bundle and document of both kinds of run."""
    root = str(tmp_path / "run")
    models.store_run(spark, trained, root)
    train = spark.read.parquet(f"{root}/features/train/parquet")
    assert train.columns == [*trained.features, models.RETURN_TARGET] and train.count() == trained.train.count()
    back = spark.read.option("header", True).csv(f"{root}/features/test/csv")
    assert back.columns == train.columns and back.count() == trained.test.count()
    assert as_rows(models.score_returns(models.load_bundle(spark, f"{root}/bundle"), trained.test)) == as_rows(
        models.score_returns(trained.pipeline, trained.test)
    )
    document = spark.read.json(f"{root}/report").first()
    assert document["test_rows"] == trained.test.count() and 0 <= document["metrics"]["roc_auc"] <= 1
    basket = models.train_basket_model(clean_rows(spark))
    models.store_run(spark, basket, str(tmp_path / "basket"), models.BASKET_TARGET, csv=False)
    assert spark.read.json(str(tmp_path / "basket/report")).first()["metrics"]["r2"] > 0.99


def test_prep_state_matches_step_by_step(spark):
    """The single-pass fit gives what filling, clipping and scaling one after the other give."""
    df = spark.createDataFrame(
        [(float(v) if v is not None else None, float(i % 7)) for i, v in enumerate([1, 2, 2, 3, None, 4, 900, None, -50, 5, 6])],
        "x double, y double",
    )
    columns = ["x", "y"]
    fills = prep.medians(df, columns)
    filled = prep.fill(df, fills)
    limits = prep.iqr_limits(filled, columns)
    scales = prep.robust_scales(prep.clip_columns(filled, limits), columns)
    state = prep.OrderPrep(numericCols=columns, categoryCols=[]).fit(df).getOrDefault("state")
    assert (state["fills"], state["limits"], state["scales"]) == (fills, limits, scales)
