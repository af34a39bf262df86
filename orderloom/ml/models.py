"""Return-probability and basket-value models on ``pyspark.ml``."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.ml.util import DefaultParamsReader
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.ml import metrics, prep, sparse, splits
from orderloom.operators import profile
from orderloom.session import materialise, stage_scope
from orderloom.sources import files

RETURN_TARGET = "order_is_returned"
BASKET_TARGET = "order_basket_value"

# Fixed values.
INVERSE_PENALTY = 1.0
MAX_ITERATIONS = 2000
TOLERANCE = 1e-4
DEFAULT_THRESHOLD = 0.5
TOP_COEFFICIENTS = 10


@dataclass
class Trained:
    """A fitted pipeline with the frames it was fitted and checked on."""

    pipeline: PipelineModel
    features: list[str]
    train: DataFrame
    test: DataFrame
    #: Prepared training rows as the model saw them: ``label`` and the vector ``features``.
    matrix: DataFrame | None = None


def _split(clean: DataFrame, split: str, label: str, seed: int) -> tuple[DataFrame, DataFrame]:
    marked = (
        splits.stratified_split(clean, "event_id", label, seed=seed)
        if split == "stratified"
        else splits.random_split(clean, "event_id", seed=seed)
    )
    # Fitting visits the rows many times: the split is written once and read back.
    written = materialise(marked, "split")
    return written.where(~F.col("is_test")).drop("is_test"), written.where("is_test").drop("is_test")


def _plain(model):
    """The fitted model without its training summary.

    The summary holds the training frame and its session, which every task that scores would be sent; once
    the session counts an observation it can not even be sent.
    """
    jvm = SparkSession.active()._jvm
    model._java_obj.setSummary(jvm.scala.Option.empty())
    return model


def logistic(rows: DataFrame, penalty: float, tolerance: float = TOLERANCE, weight: str | None = None) -> LogisticRegressionModel:
    """L2-penalised logistic regression of ``label`` on ``features``, neither standardised."""
    model = LogisticRegression(regParam=penalty, elasticNetParam=0.0, standardization=False, maxIter=MAX_ITERATIONS, tol=tolerance)
    return _plain((model.setWeightCol(weight) if weight else model).fit(rows))


def least_squares(rows: DataFrame) -> LinearRegressionModel:
    """Ordinary least squares of ``label`` on ``features`` by the normal equations."""
    return _plain(LinearRegression(regParam=0.0, solver="normal").fit(rows))


def fit_return_model(
    train: DataFrame, exclude: Iterable[str] = (), class_weights: bool = False
) -> tuple[PipelineModel, list[str]]:
    """L2-penalised logistic regression; ``class_weights`` balances the classes."""
    pipeline, features, _ = _fit_return(train, exclude, class_weights)
    return pipeline, features


def _fit_return(train: DataFrame, exclude: Iterable[str], class_weights: bool) -> tuple[PipelineModel, list[str], DataFrame]:
    exclude = set(exclude)
    numeric = [c for c in schemas.NUMERIC_COLUMNS if c not in exclude]
    category = [c for c in schemas.CATEGORY_COLUMNS if c not in exclude]
    prepared = prep.OrderPrep(numericCols=numeric, categoryCols=category, scaler="robust").fit(train)
    assembler = VectorAssembler(inputCols=prepared.features, outputCol="features")
    rows = train.withColumn("label", F.col(RETURN_TARGET).cast("double"))
    sizes = rows.agg(F.count("label").alias("n"), F.sum("label").alias("pos")).first()
    penalty, weight = 1.0 / (INVERSE_PENALTY * max(sizes["n"], 1)), None
    if class_weights and 0 < sizes["pos"] < sizes["n"]:
        positive = sizes["n"] / (2.0 * sizes["pos"])
        negative = sizes["n"] / (2.0 * (sizes["n"] - sizes["pos"]))
        rows = rows.withColumn("weight", F.when(F.col("label") == 1, positive).otherwise(negative))
        weight = "weight"
    # Prepared once: the fit and whoever checks it read the vectors.
    kept = ["label", "features", *([weight] if weight else [])]
    matrix = materialise(assembler.transform(prepared.transform(rows)).where(F.col("label").isNotNull()).select(*kept), "matrix")
    return PipelineModel([prepared, assembler, logistic(matrix, penalty, weight=weight)]), prepared.features, matrix


def fit_sparse_return_model(
    train: DataFrame, category: Iterable[str] = schemas.CATEGORY_COLUMNS, index_path: str | None = None, exclude: Iterable[str] = ()
) -> PipelineModel:
    """The return model with categories of any number of values (ids, for instance), as one sparse vector a row."""
    exclude = set(exclude)
    numeric = [c for c in schemas.NUMERIC_COLUMNS if c not in exclude]
    category = [c for c in category if c not in exclude]
    prepared = sparse.SparsePrep(numericCols=numeric, categoryCols=category, scaler="robust", indexPath=index_path).fit(train)
    rows = prepared.transform(train.withColumn("label", F.col(RETURN_TARGET).cast("double")))
    # The fit visits the rows many times; what it reads is the vector.
    matrix = materialise(rows.where(F.col("label").isNotNull()).select("label", "features"), "sparse_features")
    return PipelineModel([prepared, logistic(matrix, 1.0 / (INVERSE_PENALTY * max(matrix.count(), 1)))])


def sparse_coefficients(spark: SparkSession, pipeline: PipelineModel) -> DataFrame:
    """Coefficient per feature name of a sparse model."""
    values = [(i, float(v)) for i, v in enumerate(pipeline.stages[-1].coefficients)]
    coefs = spark.createDataFrame(values, "place bigint, coef double")
    return pipeline.stages[0].names(spark).join(coefs, "place").select("feature", "coef")


def fit_basket_model(train: DataFrame, exclude: Iterable[str] = ()) -> tuple[PipelineModel, list[str]]:
    """Ordinary least squares on the basket value.

    The order total nearly determines the target; pass it in ``exclude`` for a
    model without that leak.
    """
    pipeline, features, _ = _fit_basket(train, exclude)
    return pipeline, features


def _fit_basket(train: DataFrame, exclude: Iterable[str]) -> tuple[PipelineModel, list[str], DataFrame]:
    exclude = {BASKET_TARGET, *exclude}
    numeric = [c for c in schemas.NUMERIC_COLUMNS if c not in exclude]
    category = [c for c in schemas.CATEGORY_COLUMNS if c not in exclude]
    prepared = prep.OrderPrep(
        numericCols=numeric, categoryCols=category, boolCols=[RETURN_TARGET], scaler="standard"
    ).fit(train)
    assembler = VectorAssembler(inputCols=prepared.features, outputCol="features")
    rows = train.withColumn("label", F.col(BASKET_TARGET).cast("double"))
    matrix = materialise(assembler.transform(prepared.transform(rows)).select("label", "features"), "matrix")
    return PipelineModel([prepared, assembler, least_squares(matrix)]), prepared.features, matrix


def split_returns(clean: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of the return model, as written."""
    return _split(clean, "stratified", RETURN_TARGET, seed)


def split_baskets(clean: DataFrame, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Training and test rows of the basket model, as written."""
    return _split(clean, "random", BASKET_TARGET, seed)


def train_return_model(clean: DataFrame, seed: int = 42, **options) -> Trained:
    return train_returns(*split_returns(clean, seed), **options)


def train_returns(train: DataFrame, test: DataFrame, **options) -> Trained:
    pipeline, features, matrix = _fit_return(train, options.pop("exclude", ()), options.pop("class_weights", False), **options)
    return Trained(pipeline, features, train, test, matrix)


def train_basket_model(clean: DataFrame, seed: int = 42, **options) -> Trained:
    return train_baskets(*split_baskets(clean, seed), **options)


def train_baskets(train: DataFrame, test: DataFrame, **options) -> Trained:
    pipeline, features, matrix = _fit_basket(train, options.pop("exclude", ()), **options)
    return Trained(pipeline, features, train, test, matrix)


def score_returns(
    pipeline: PipelineModel, rows: DataFrame, threshold: float = DEFAULT_THRESHOLD, keep: Iterable[str] = schemas.ID_COLUMNS
) -> DataFrame:
    """``keep`` columns, probability of a return, and the decision at the threshold."""
    scored = pipeline.transform(rows)
    proba = vector_to_array("probability")[1]
    return scored.select(*keep, proba.alias("return_proba"), (proba > threshold).alias("predicted_return"))


def coefficients(spark: SparkSession, pipeline: PipelineModel, features: list[str]) -> DataFrame:
    """Coefficient per feature name (one row per feature)."""
    values = [float(v) for v in pipeline.stages[-1].coefficients]
    return spark.createDataFrame(list(zip(features, values, strict=True)), "feature string, coef double")


def top_coefficients(coefs: DataFrame, n: int = TOP_COEFFICIENTS) -> DataFrame:
    """The ``n`` largest and the ``n`` smallest coefficients, ranked within each side."""
    top = coefs.orderBy(F.col("coef").desc(), "feature").limit(n).withColumn("side", F.lit("positive"))
    low = coefs.orderBy(F.col("coef").asc(), F.col("feature").desc()).limit(n).withColumn("side", F.lit("negative"))
    return top.unionByName(low)


def feature_sets(trained: Trained, target: str) -> dict[str, DataFrame]:
    """The prepared training and test rows: the model's features and the target."""
    prepared = trained.pipeline.stages[0]
    return {side: prepared.transform(rows).select(*trained.features, target) for side, rows in (("train", trained.train), ("test", trained.test))}


def store_run(spark: SparkSession, trained: Trained, root: str, target: str = RETURN_TARGET, csv: bool = True) -> None:
    """What a training run leaves behind: both feature sets, the bundle, and the document about it, under ``root``."""
    for side, frame in feature_sets(trained, target).items():
        files.write_features(frame, f"{root}/features/{side}", csv)
    save_bundle(trained.pipeline, f"{root}/bundle")
    with stage_scope(spark):
        report = return_model_report(spark, trained) if target == RETURN_TARGET else basket_model_report(spark, trained)
        files.write_document(report, f"{root}/report")


def save_bundle(pipeline: PipelineModel, path: str) -> None:
    """Preparation and model together."""
    pipeline.write().overwrite().save(path)


def load_bundle(spark: SparkSession, path: str) -> PipelineModel:
    """A saved bundle; a bare saved classifier is accepted as a bundle without preparation."""
    kind = DefaultParamsReader.loadMetadata(path, spark.sparkContext)["class"]
    if kind.endswith("PipelineModel"):
        return PipelineModel.load(path)
    return PipelineModel([LogisticRegressionModel.load(path)])


def return_model_report(spark: SparkSession, trained: Trained, threshold: float = DEFAULT_THRESHOLD) -> DataFrame:
    """One-row document about a training run: data, metrics, matrix, report, coefficients."""
    scored = score_returns(
        trained.pipeline, trained.test, threshold, keep=["event_id", F.col(RETURN_TARGET).cast("int").alias("label")]
    )
    # Scored once; the parts of the document read the scores.
    scored = materialise(scored, "report_scores")
    measures = metrics.classification_metrics(scored, "label", "return_proba", threshold)
    report = metrics.classification_report(scored, "label", "return_proba", threshold)
    matrix = metrics.confusion(scored, "label", "return_proba", threshold)
    coefs = top_coefficients(coefficients(spark, trained.pipeline, trained.features))
    parts = {
        "metrics": measures.select(F.struct("*").alias("metrics")),
        "confusion_matrix": matrix.select(F.struct("*").alias("confusion_matrix")),
        "classification_report": report.agg(F.collect_list(F.struct("*")).alias("classification_report")),
        "interpretability": coefs.agg(F.collect_list(F.struct("*")).alias("interpretability")),
        "class_balance_train": profile.class_balance(trained.train, RETURN_TARGET).select(
            F.struct("*").alias("class_balance_train")
        ),
        "class_balance_test": profile.class_balance(trained.test, RETURN_TARGET).select(
            F.struct("*").alias("class_balance_test")
        ),
    }
    return _document(spark, trained, parts, RETURN_TARGET)


def basket_model_report(spark: SparkSession, trained: Trained) -> DataFrame:
    """One-row document about a regression run."""
    # The target is no feature, so it passes through the preparation with its row.
    scored = materialise(trained.pipeline.transform(trained.test).select("event_id", BASKET_TARGET, "prediction"), "report_scores")
    coefs = top_coefficients(coefficients(spark, trained.pipeline, trained.features))
    parts = {
        "metrics": metrics.regression_metrics(scored, BASKET_TARGET, "prediction").select(
            F.struct("*").alias("metrics")
        ),
        "residuals": metrics.residual_summary(scored, BASKET_TARGET, "prediction").select(
            F.struct("*").alias("residuals")
        ),
        "target_summary_train": profile.target_summary(trained.train, BASKET_TARGET).select(
            F.struct("*").alias("target_summary_train")
        ),
        "target_summary_test": profile.target_summary(trained.test, BASKET_TARGET).select(
            F.struct("*").alias("target_summary_test")
        ),
        "interpretability": coefs.agg(F.collect_list(F.struct("*")).alias("interpretability")),
    }
    return _document(spark, trained, parts, BASKET_TARGET)


def _document(spark: SparkSession, trained: Trained, parts: dict[str, DataFrame], target: str) -> DataFrame:
    params = {p.name: str(v) for p, v in trained.pipeline.stages[-1].extractParamMap().items()}
    one = F.count(F.lit(1))
    return spark.range(1).select(
        F.uuid().alias("run_id"),
        F.current_timestamp().alias("created_at"),
        F.lit(spark.version).alias("spark_version"),
        F.lit(target).alias("target_name"),
        F.lit(len(trained.features)).alias("n_features"),
        F.array(*[F.lit(f) for f in trained.features]).alias("feature_names"),
        F.create_map(*[F.lit(x) for kv in sorted(params.items()) for x in kv]).alias("model_params"),
        trained.train.agg(one).scalar().alias("train_rows"),
        trained.test.agg(one).scalar().alias("test_rows"),
        *[frame.scalar().alias(name) for name, frame in parts.items()],
    )
