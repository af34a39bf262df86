"""Queries: splits, feature preparation, models, metrics."""

from __future__ import annotations

from pyspark.ml.evaluation import BinaryClassificationEvaluator, RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.ml import metrics, models, prep, sparse, splits
from orderloom.plans import frames, oracle
from orderloom.plans.catalog_reports import DIGITS, rounded
from orderloom.plans.registry import query
from orderloom.plans.stages import stage
from orderloom.session import materialise, shared_dir, stage_scope

_NUMERIC = list(schemas.NUMERIC_COLUMNS)
_TRAIN_STEP = ["order_n_items", "order_basket_value", "order_discount", "event_month"]

# ---- splits ----------------------------------------------------------------


@query("split_random", oracle.sql("clean", f"SELECT event_id, {oracle.HASH} < 0.2e0 AS is_test FROM clean"))
def split_random(spark, sf):
    return splits.random_split(frames.clean_table(spark, sf), "event_id").select("event_id", "is_test")


@query(
    "split_stratified",
    oracle.sql(
        "clean",
        f"""SELECT event_id, order_is_returned, row_number() OVER (PARTITION BY order_is_returned ORDER BY {oracle.HASH})
                   <= round_even(count(*) OVER (PARTITION BY order_is_returned) * 0.2e0, 0) AS is_test FROM clean""",
    ),
)
def split_stratified(spark, sf):
    marked = splits.stratified_split(frames.clean_table(spark, sf), "event_id", "order_is_returned")
    return marked.select("event_id", "order_is_returned", "is_test")


# ---- preparation steps -----------------------------------------------------


def _with_gaps(spark, sf):
    """Cleaned log before imputation, so every step has gaps to fill."""
    return frames.dedup_table(spark, sf)


@query(
    "impute_median",
    oracle.sql(
        "dedup",
        f"""SELECT event_id, coalesce(order_discount, (SELECT {oracle.median('order_discount')} FROM dedup)) AS order_discount,
                  coalesce(CAST(order_n_items AS DOUBLE), (SELECT {oracle.median('order_n_items')} FROM dedup)) AS order_n_items FROM dedup""",
    ),
)
def impute_median(spark, sf):
    rows = _with_gaps(spark, sf).withColumn("order_n_items", F.col("order_n_items").cast("double"))
    columns = ["order_discount", "order_n_items"]
    return prep.fill(rows, prep.medians(rows, columns)).select("event_id", *columns)


@query(
    "impute_mode",
    oracle.sql(
        "dedup",
        "SELECT event_id, "
        + ", ".join(
            f"coalesce({c}, (SELECT {c} FROM dedup WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY count(*) DESC, {c} LIMIT 1)) AS {c}"
            for c in ("customer_country", "order_channel")
        )
        + " FROM dedup",
    ),
)
def impute_mode(spark, sf):
    rows, columns = _with_gaps(spark, sf), ["customer_country", "order_channel"]
    return prep.fill(rows, prep.most_frequent(rows, columns)).select("event_id", *columns)


_CLIPPED = ["order_shipping_fee", "order_discount", "price_average_per_item"]


@query(
    "iqr_clip",
    oracle.sql(
        "clean",
        "SELECT event_id, "
        + ", ".join(f"greatest(least({c}, {c}_q3 + 1.5e0 * ({c}_q3 - {c}_q1)), {c}_q1 - 1.5e0 * ({c}_q3 - {c}_q1)) AS {c}" for c in _CLIPPED)
        + " FROM clean, (SELECT "
        + ", ".join(f"{oracle.quantile(c, 0.25)} AS {c}_q1, {oracle.quantile(c, 0.75)} AS {c}_q3" for c in _CLIPPED)
        + " FROM clean)",
    ),
)
def iqr_clip(spark, sf):
    rows = frames.clean_table(spark, sf).select("event_id", *_CLIPPED)
    return prep.IqrClipper(inputCols=_CLIPPED).fit(rows).transform(rows)


def _slot(column: str) -> str:
    """Number of a value among the column's values but the first, NULL for that one."""
    return f"CASE WHEN {column}_rank > 1 THEN {column}_rank - 2 END AS {column}_slot"


@query(
    "one_hot_slots",
    oracle.sql(
        "clean",
        f"""SELECT event_id, {_slot('order_main_category')}, {_slot('customer_customer_id')}
            FROM (SELECT event_id, dense_rank() OVER (ORDER BY order_main_category) AS order_main_category_rank,
                         dense_rank() OVER (ORDER BY customer_customer_id) AS customer_customer_id_rank FROM clean)""",
    ),
)
def one_hot_slots(spark, sf):
    """Places of the values of a small category and of a column with very many values in their sparse vectors."""
    columns = ["order_main_category", "customer_customer_id"]
    rows = frames.clean_table(spark, sf).select("event_id", *columns)
    path = shared_dir(spark, "slots")
    sparse.build_index(rows, columns, path)
    return sparse.slots(rows, columns, path).select("event_id", *[f"{c}_slot" for c in columns])


_SEGMENTS = ["building", "furniture", "household", "machinery"]


@query(
    "one_hot",
    oracle.sql(
        "clean",
        "SELECT event_id, "
        + ", ".join(f"CASE WHEN order_main_category = '{s}' THEN 1e0 ELSE 0e0 END AS order_main_category_{s}" for s in _SEGMENTS)
        + ", CASE WHEN order_device = 'mobile' THEN 1e0 ELSE 0e0 END AS order_device_mobile FROM clean",
    ),
)
def one_hot(spark, sf):
    rows = frames.clean_table(spark, sf).select("event_id", "order_main_category", "order_device")
    return prep.one_hot(rows, prep.categories(rows, ["order_main_category", "order_device"]))


@query(
    "robust_scale",
    oracle.sql(
        "clean",
        "SELECT event_id, "
        + ", ".join(f"({c} - {c}_m) / CASE WHEN {c}_w = 0 THEN 1e0 ELSE {c}_w END AS {c}" for c in _TRAIN_STEP)
        + " FROM clean, (SELECT "
        + ", ".join(
            f"{oracle.quantile(c, 0.5)} AS {c}_m, {oracle.quantile(c, 0.75)} - {oracle.quantile(c, 0.25)} AS {c}_w"
            for c in _TRAIN_STEP
        )
        + " FROM clean)",
    ),
)
def robust_scale(spark, sf):
    rows = frames.clean_table(spark, sf).select("event_id", *_TRAIN_STEP)
    return prep.scale_columns(rows, prep.robust_scales(rows, _TRAIN_STEP))


@query(
    "standard_scale",
    oracle.sql(
        "clean",
        "SELECT event_id, "
        + ", ".join(
            f"round(({c} - {c}_m) / CASE WHEN {c}_s = 0 THEN 1e0 ELSE {c}_s END, {DIGITS}) AS {c}" for c in _TRAIN_STEP
        )
        + " FROM clean, (SELECT "
        + ", ".join(f"avg({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in _TRAIN_STEP)
        + " FROM clean)",
    ),
)
def standard_scale(spark, sf):
    rows = frames.clean_table(spark, sf).select("event_id", *_TRAIN_STEP)
    return rounded(prep.scale_columns(rows, prep.standard_scales(rows, _TRAIN_STEP)), *_TRAIN_STEP)


_AUDITED = ["order_n_items", "order_basket_value", "order_discount", "event_hour"]


@query(
    "feature_audit",
    oracle.sql(
        "dedup",
        "\nUNION ALL\n".join(
            f"""SELECT '{side}' AS side, count(*) - count(order_discount) AS n_missing, true AS same_columns,
                       CAST(1 AS INTEGER) AS n_constant FROM dedup WHERE {oracle.HASH} {op} 0.2e0"""
            for side, op in (("train", ">="), ("test", "<"))
        ),
    ),
)
def feature_audit(spark, sf):
    """Hour is constant in this log and the discount has gaps: both must be reported."""
    rows = _with_gaps(spark, sf).withColumn("event_hour", F.hour("event_time"))
    marked = splits.random_split(rows, "event_id").select(
        "is_test", *[F.col(c).cast("double").alias(c) for c in _AUDITED]
    )
    train, test = (marked.where(c).drop("is_test") for c in (~F.col("is_test"), F.col("is_test")))
    return prep.feature_audit(train, test, _AUDITED)


# ---- models ----------------------------------------------------------------
# A model is fitted once per session and table folder, on the written clean set.


@stage
def return_split(spark, sf):
    """Training and test rows; queries that fit something smaller need no more of a run."""
    return models.split_returns(frames.clean_table(spark, sf))


@stage
def basket_split(spark, sf):
    return models.split_baskets(frames.clean_table(spark, sf))


@stage
def return_run(spark, sf):
    return models.train_returns(*return_split(spark, sf))


@stage
def return_pipeline(spark, sf):
    """The fitted return model by itself, for who only scores: what its training wrote is removed, unless other queries keep it."""
    run = return_run.held(spark, sf)
    if run is not None:
        return run.pipeline
    with stage_scope(spark):
        split = return_split.held(spark, sf) or models.split_returns(frames.own_clean_table(spark, sf))
        return models.train_returns(*split).pipeline


@stage
def basket_run(spark, sf):
    return models.train_baskets(*basket_split(spark, sf))


# Coefficients and probabilities have no value that SQL could compute.  Each query below returns who got one and
# whether it meets the condition that defines it; the figures themselves come from ``models``.

_STATIONARY = 1e-3
_CATEGORIES = list(schemas.CATEGORY_COLUMNS)


def _gradients(run, predicted, penalty: float):
    """Per feature: the slope of the mean loss on the training rows, in the coefficient.  Reads the vectors that the fit read."""
    model = run.pipeline.stages[-1]
    rows = model.transform(run.matrix).select((predicted - F.col("label")).alias("off"), vector_to_array("features").alias("x"))
    sums = rows.agg(*[F.avg(F.col("off") * F.col("x")[i]).alias(f"s{i}") for i in range(len(run.features))])
    penalties = [penalty * float(v) for v in model.coefficients]
    named = enumerate(zip(run.features, penalties, strict=True))
    slopes = [F.struct(F.lit(f).alias("feature"), (F.col(f"s{i}") + F.lit(p)).alias("slope")) for i, (f, p) in named]
    return sums.select(F.inline(F.array(*slopes)))


def _feature_list(train: str, numeric, bools=()) -> str:
    """The features that a fit on ``train`` has: numbers, booleans, and all values but the first per category."""
    fixed = ", ".join(f"('{c}')" for c in [*numeric, *bools])
    hot = " UNION ALL ".join(
        f"SELECT concat('{c}_', v) AS feature FROM (SELECT DISTINCT {c} AS v FROM {train}) WHERE v > (SELECT min({c}) FROM {train})"
        for c in _CATEGORIES
    )
    return f"SELECT feature, true AS stationary FROM (SELECT * FROM (VALUES {fixed}) AS t(feature) UNION ALL {hot})"


@query("train_logistic", oracle.sql("train_strata", _feature_list("train_strata", _NUMERIC)))
def train_logistic(spark, sf):
    """Every feature's coefficient is finite and the penalised log-loss is flat in it."""
    run = return_run(spark, sf)
    penalty = run.pipeline.stages[-1].getOrDefault("regParam")
    flat = F.abs("slope") < _STATIONARY
    return _gradients(run, vector_to_array("probability")[1], penalty).select("feature", flat.alias("stationary"))


@query(
    "train_linear",
    oracle.sql("train", _feature_list("train", [c for c in _NUMERIC if c != models.BASKET_TARGET], [models.RETURN_TARGET])),
)
def train_linear(spark, sf):
    """Every feature is uncorrelated with the residual, as least squares demands (relative to the target's spread)."""
    run = basket_run(spark, sf)
    spread = run.train.agg(F.stddev_pop(models.BASKET_TARGET)).scalar()
    flat = F.abs("slope") < _STATIONARY * spread
    return _gradients(run, F.col("prediction"), 0.0).select("feature", flat.alias("stationary"))


# What a fit with a free intercept and an indicator per category value implies for its predictions, in figures that SQL has: over the
# training rows, and over those of each value, they have the mean of the target.  The penalty moves the classifier's means a little.


@query(
    "logistic_group_means",
    oracle.sql(
        "train_strata",
        """SELECT order_main_category, count(*) AS n, round(avg(CAST(order_is_returned AS DOUBLE)), 2) AS mean_proba FROM train_strata
           GROUP BY order_main_category""",
    ),
)
def logistic_group_means(spark, sf):
    run = return_run(spark, sf)
    scores = models.score_returns(run.pipeline, run.train.withColumn("group", F.col("order_main_category")), keep=["group"])
    means = scores.groupBy(F.col("group").alias("order_main_category")).agg(F.count(F.lit(1)).alias("n"), F.avg("return_proba").alias("mean_proba"))
    return means.withColumn("mean_proba", F.round("mean_proba", 2))


@query(
    "linear_group_means",
    oracle.sql(
        "train",
        """SELECT order_main_category, count(*) AS n, round(avg(order_basket_value), 0) AS mean_prediction FROM train
           GROUP BY order_main_category""",
    ),
)
def linear_group_means(spark, sf):
    run = basket_run(spark, sf)
    rows = run.pipeline.transform(run.train.withColumn("group", F.col("order_main_category")))
    means = rows.groupBy(F.col("group").alias("order_main_category")).agg(F.count(F.lit(1)).alias("n"), F.avg("prediction").alias("mean_prediction"))
    return means.withColumn("mean_prediction", F.round("mean_prediction", 0))


_TWO = """(SELECT count(*) AS n, covar_pop(order_basket_value, a) AS ya, covar_pop(order_basket_value, b) AS yb, covar_pop(a, b) AS ab,
    var_pop(a) AS aa, var_pop(b) AS bb, avg(order_basket_value) AS y, avg(a) AS ma, avg(b) AS mb
    FROM (SELECT order_basket_value, order_shipping_fee AS a, CAST(order_n_items AS DOUBLE) AS b FROM train))"""


@query(
    "linear_two_features",
    oracle.sql(
        "train",
        f"""SELECT feature, round(v, {DIGITS}) AS value FROM (
              SELECT unnest([('order_shipping_fee', p), ('order_n_items', q), ('intercept', y - p * ma - q * mb)]::STRUCT(feature VARCHAR, v DOUBLE)[], recursive := true)
              FROM (SELECT *, (ya * bb - yb * ab) / (aa * bb - ab * ab) AS p, (yb * aa - ya * ab) / (aa * bb - ab * ab) AS q FROM {_TWO}))""",
    ),
)
def linear_two_features(spark, sf):
    """Coefficients of least squares on two unscaled features, as the normal equations give them."""
    columns = ["order_shipping_fee", "order_n_items"]
    train, _ = basket_split(spark, sf)
    rows = VectorAssembler(inputCols=columns, outputCol="features").transform(train.withColumn("label", F.col(models.BASKET_TARGET)))
    fitted = models.least_squares(rows)
    values = [*zip(columns, map(float, fitted.coefficients), strict=True), ("intercept", float(fitted.intercept))]
    return rounded(spark.createDataFrame(values, "feature string, value double"), "value")


@query(
    "logistic_one_indicator",
    oracle.sql(
        "train_strata",
        """SELECT round(ln(q / (1 - q)) - ln(p / (1 - p)), 4) AS coefficient, round(ln(p / (1 - p)), 4) AS intercept FROM (
             SELECT avg(CAST(order_is_returned AS DOUBLE)) FILTER (WHERE order_device <> 'mobile') AS p,
                    avg(CAST(order_is_returned AS DOUBLE)) FILTER (WHERE order_device = 'mobile') AS q FROM train_strata)""",
    ),
)
def logistic_one_indicator(spark, sf):
    """The unpenalised classifier on one indicator: log odds of either side.

    Equal rows enter the likelihood as often as they occur, so the solver gets each (label, indicator) once, weighted.
    """
    train, _ = return_split(spark, sf)
    rows = train.select(F.col(models.RETURN_TARGET).cast("double").alias("label"), (F.col("order_device") == "mobile").cast("double").alias("x"))
    cells = rows.na.drop().groupBy("label", "x").agg(F.count(F.lit(1)).cast("double").alias("weight"))
    vectors = VectorAssembler(inputCols=["x"], outputCol="features").transform(cells)
    fitted = models.logistic(vectors, penalty=0.0, tolerance=1e-10, weight="weight")
    found = (round(float(fitted.coefficients[0]), 4), round(float(fitted.intercept), 4))
    return spark.createDataFrame([found], "coefficient double, intercept double")


@query(
    "score_batch",
    oracle.sql("test_strata", f"SELECT {', '.join(schemas.ID_COLUMNS)}, true AS proba_valid, true AS decision_valid FROM test_strata"),
)
def score_batch(spark, sf):
    """One score per test row; the probability is the logistic of the fitted margin, the decision its comparison with 0.5."""
    run = return_run(spark, sf)
    model = run.pipeline.stages[-1]
    rows = models.score_returns(run.pipeline, run.test, keep=[*schemas.ID_COLUMNS, *run.features])
    margin = F.lit(float(model.intercept))
    for feature, weight in zip(run.features, model.coefficients, strict=True):
        margin = margin + F.col(feature) * F.lit(float(weight))
    proba = F.col("return_proba")
    return rows.select(
        *schemas.ID_COLUMNS,
        (F.abs(proba - 1.0 / (1.0 + F.exp(-margin))) < 1e-9).alias("proba_valid"),
        (F.col("predicted_return") == (proba > models.DEFAULT_THRESHOLD)).alias("decision_valid"),
    )


@query(
    "coef_topk",
    f"""SELECT side, CAST(rank AS INTEGER) AS rank, true AS in_order
        FROM (VALUES ('positive'), ('negative')) AS s(side), range(1, {models.TOP_COEFFICIENTS + 1}) AS r(rank)""",
)
def coef_topk(spark, sf):
    """Sides and ranks of the reported coefficients; each has exactly the better ones before it."""
    run = return_run(spark, sf)
    coefs = models.coefficients(spark, run.pipeline, run.features)
    every = coefs.agg(F.collect_list("coef")).scalar()  # one number per feature
    place = Window.partitionBy("side").orderBy(F.when(F.col("side") == "positive", -F.col("coef")).otherwise(F.col("coef")), "feature")
    ranked = models.top_coefficients(coefs).withColumn("rank", F.row_number().over(place)).withColumn("every", every)
    positive = F.col("side") == "positive"
    better = F.size(F.filter("every", lambda v: F.when(positive, v > F.col("coef")).otherwise(v < F.col("coef"))))
    no_worse = F.size(F.filter("every", lambda v: F.when(positive, v >= F.col("coef")).otherwise(v <= F.col("coef"))))
    return ranked.select("side", "rank", ((better < F.col("rank")) & (F.col("rank") <= no_worse)).alias("in_order"))


def _hot(column: str) -> str:
    known = f"SELECT DISTINCT {column} FROM train_strata WHERE {column} > (SELECT min({column}) FROM train_strata)"
    return f"CASE WHEN {column} IN ({known}) THEN concat('{column}_', {column}) END"


_REPLAYED = oracle.sql(
    "train_strata normalized",
    ", fitted AS (SELECT "
    + ", ".join(
        f"{oracle.median(c)} AS {c}_m, {oracle.quantile(c, 0.25)} AS {c}_q1, {oracle.quantile(c, 0.75)} AS {c}_q3" for c in _NUMERIC
    )
    + " FROM train_strata), cut AS (SELECT "
    + ", ".join(
        f"greatest(least(CAST({c} AS DOUBLE), {c}_q3 + 1.5e0 * ({c}_q3 - {c}_q1)), {c}_q1 - 1.5e0 * ({c}_q3 - {c}_q1)) AS {c}"
        for c in _NUMERIC
    )
    + " FROM train_strata, fitted), scales AS (SELECT "
    + ", ".join(
        f"{oracle.median(c)} AS {c}_c, {oracle.quantile(c, 0.75)} - {oracle.quantile(c, 0.25)} AS {c}_w" for c in _NUMERIC
    )
    + " FROM cut) SELECT position, event_id, order_id, customer_customer_id, "
    + ", ".join(
        f"(greatest(least(CAST({c} AS DOUBLE), {c}_q3 + 1.5e0 * ({c}_q3 - {c}_q1)), {c}_q1 - 1.5e0 * ({c}_q3 - {c}_q1)) - {c}_c)"
        f" / CASE WHEN {c}_w = 0 THEN 1e0 ELSE {c}_w END AS {c}"
        for c in _NUMERIC
    )
    + f", concat_ws(',', {', '.join(map(_hot, _CATEGORIES))}) AS indicators FROM normalized, fitted, scales",
)


@query("prep_replay", _REPLAYED)
def prep_replay(spark, sf):
    """Serving-time preparation of normalised messages with the fitted state; indicator columns are listed by name."""
    rows = frames.normalized(spark, sf).drop("event_time", "order_is_returned")
    fitted = return_run(spark, sf).pipeline.stages[0]
    hot = [f for f in fitted.features if f not in _NUMERIC]
    names = F.concat_ws(",", *[F.when(F.col(f) == 1.0, F.lit(f)) for f in hot])
    return fitted.transform(rows).select("position", *schemas.ID_COLUMNS, *_NUMERIC, names.alias("indicators"))


def _agree(computed: DataFrame, expected: DataFrame) -> DataFrame:
    """Per column of two one-row frames: do they hold the same number?"""
    rows = computed.select(F.struct("*").alias("a"), expected.select(F.struct("*")).scalar().alias("b"))
    pairs = [
        F.struct(F.lit(c).alias("metric"), (F.abs(F.col(f"a.`{c}`") - F.col(f"b.`{c}`")) < 1e-9).alias("agrees"))
        for c in expected.columns
    ]
    return rows.select(F.inline(F.array(*pairs)))


def _names(*metric: str) -> str:
    return "SELECT metric, true AS agrees FROM (VALUES " + ", ".join(f"('{m}')" for m in metric) + ") AS t(metric)"


@query("return_model_metrics", _names("accuracy", "precision", "recall", "f1", "log_loss", "brier_score", "roc_auc"))
def return_model_metrics(spark, sf):
    """Measures of the fitted classifier against those that ``pyspark.ml`` and plain averages give on its scores."""
    run = return_run(spark, sf)
    label = F.col(models.RETURN_TARGET).cast("int").alias("label")
    scored = materialise(models.score_returns(run.pipeline, run.test, keep=["event_id", label]), "return-scores")
    p, y, said = F.col("return_proba"), F.col("label"), F.col("predicted_return").cast("int")
    hits, said_yes, yes = F.sum(said * y), F.sum(said), F.sum(y)
    area = BinaryClassificationEvaluator(rawPredictionCol="return_proba", numBins=0).evaluate(scored)
    plain = scored.agg(
        F.avg((said == y).cast("double")).alias("accuracy"),
        F.coalesce(F.try_divide(hits, said_yes), F.lit(0.0)).alias("precision"),
        F.coalesce(F.try_divide(hits, yes), F.lit(0.0)).alias("recall"),
        F.coalesce(F.try_divide(2 * hits, said_yes + yes), F.lit(0.0)).alias("f1"),
        F.avg(-F.when(y == 1, F.ln(p)).otherwise(F.ln(1 - p))).alias("log_loss"),
        F.avg((p - y) * (p - y)).alias("brier_score"),
        F.lit(area).alias("roc_auc"),
    )
    return _agree(metrics.classification_metrics(scored, "label", "return_proba"), plain)


@query("basket_model_metrics", _names("mae", "mse", "rmse", "r2"))
def basket_model_metrics(spark, sf):
    """Measures of the fitted regression against those that ``pyspark.ml`` gives on its predictions."""
    run = basket_run(spark, sf)
    predicted = run.pipeline.transform(run.test.withColumn("actual", F.col(models.BASKET_TARGET))).select("actual", "prediction")
    predicted = materialise(predicted, "basket-scores")
    by_ml = {m: RegressionEvaluator(labelCol="actual", metricName=m).evaluate(predicted) for m in ("mae", "mse", "rmse", "r2")}
    plain = spark.range(1).select(*[F.lit(v).alias(m) for m, v in by_ml.items()])
    ours = metrics.regression_metrics(predicted, "actual", "prediction")
    # The errors are relative to the size of the target.
    size = predicted.agg(F.stddev_pop("actual")).scalar()
    relative = {"mae": F.col("mae") / size, "mse": F.col("mse") / (size * size), "rmse": F.col("rmse") / size}
    return _agree(ours.withColumns(relative), plain.withColumns(relative))


# ---- metrics ---------------------------------------------------------------

# The rule score lies around its base value, so this threshold splits it.
_THRESHOLD = 0.2
_COUNTS = f"""SELECT CAST(count(CASE WHEN label = 0 AND score <= {_THRESHOLD}e0 THEN 1 END) AS DOUBLE) AS tn,
    CAST(count(CASE WHEN label = 0 AND score > {_THRESHOLD}e0 THEN 1 END) AS DOUBLE) AS fp,
    CAST(count(CASE WHEN label = 1 AND score <= {_THRESHOLD}e0 THEN 1 END) AS DOUBLE) AS fn,
    CAST(count(CASE WHEN label = 1 AND score > {_THRESHOLD}e0 THEN 1 END) AS DOUBLE) AS tp FROM scored"""


def _auc(score: str) -> str:
    return f"""(SELECT CAST(sum(pos * (2 * (SELECT 0) + 2 * before + neg)) AS DOUBLE) / (2e0 * sum(pos) * sum(neg)) FROM (
        SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM (
          SELECT {score} AS s, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY {score})))"""


def _ap(score: str) -> str:
    return f"""(SELECT sum(pos * (tp / (tp + fp))) / sum(pos) FROM (
        SELECT CAST(pos AS DOUBLE) AS pos, CAST(sum(pos) OVER (ORDER BY s DESC) AS DOUBLE) AS tp, CAST(sum(neg) OVER (ORDER BY s DESC) AS DOUBLE) AS fp FROM (
          SELECT {score} AS s, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY {score})))"""


@query(
    "clf_metrics",
    oracle.sql(
        "scored",
        f"""SELECT (tp + tn) / (tp + tn + fp + fn) AS accuracy, tp / (tp + fp) AS "precision", tp / (tp + fn) AS recall,
              2 * tp / (2 * tp + fp + fn) AS f1, (tp / (tp + fn) + tn / (tn + fp)) / 2 AS balanced_accuracy,
              round((tp * tn - fp * fn) / (sqrt(tp + fp) * sqrt(tp + fn) * sqrt(tn + fp) * sqrt(tn + fn)), {DIGITS}) AS matthews_corrcoef,
              {_auc('score')} AS roc_auc, round({_ap('score')}, {DIGITS}) AS pr_auc,
              round((SELECT avg(-CASE WHEN label = 1 THEN ln(score) ELSE ln(1 - score) END) FROM scored), {DIGITS}) AS log_loss,
              round((SELECT avg((score - label) * (score - label)) FROM scored), {DIGITS}) AS brier_score,
              {_THRESHOLD}e0 AS threshold
            FROM ({_COUNTS})""",
    ),
)
def clf_metrics(spark, sf):
    out = metrics.classification_metrics(frames.scored(spark, sf), "label", "score", _THRESHOLD)
    return rounded(out, "matthews_corrcoef", "pr_auc", "log_loss", "brier_score")


@query(
    "confusion_matrix",
    oracle.sql("scored", f"SELECT {', '.join(f'CAST({c} AS BIGINT) AS {c}' for c in ('tn', 'fp', 'fn', 'tp'))} FROM ({_COUNTS})"),
)
def confusion_matrix(spark, sf):
    return metrics.confusion(frames.scored(spark, sf), "label", "score", _THRESHOLD)


_P0, _P1, _R0, _R1 = "tn / (tn + fn)", "tp / (tp + fp)", "tn / (tn + fp)", "tp / (tp + fn)"
_F0, _F1 = "2 * tn / (2 * tn + fn + fp)", "2 * tp / (2 * tp + fp + fn)"
_S0, _S1, _N, _A = "(tn + fp)", "(tp + fn)", "(tn + fp + tp + fn)", "(tp + tn) / (tp + tn + fp + fn)"


def _weighted(a: str, b: str) -> str:
    return f"({a} * {_S0} + {b} * {_S1}) / {_N}"


@query(
    "clf_report",
    oracle.sql(
        "scored",
        f""", c AS ({_COUNTS})
            SELECT '0' AS "class", {_P0} AS "precision", {_R0} AS recall, {_F0} AS f1_score, {_S0} AS support FROM c
            UNION ALL SELECT '1', {_P1}, {_R1}, {_F1}, {_S1} FROM c
            UNION ALL SELECT 'accuracy', {_A}, {_A}, {_A}, {_N} FROM c
            UNION ALL SELECT 'macro avg', ({_P0} + {_P1}) / 2, ({_R0} + {_R1}) / 2, ({_F0} + {_F1}) / 2, {_N} FROM c
            UNION ALL SELECT 'weighted avg', {_weighted(_P0, _P1)}, {_weighted(_R0, _R1)}, {_weighted(_F0, _F1)}, {_N} FROM c""",
    ),
)
def clf_report(spark, sf):
    return metrics.classification_report(frames.scored(spark, sf), "label", "score", _THRESHOLD)


@query("roc_auc", oracle.sql("scored", f"SELECT {_auc('smooth')} AS roc_auc"))
def roc_auc(spark, sf):
    return metrics.roc_auc(frames.scored(spark, sf), "label", "smooth")


@query("avg_precision", oracle.sql("scored", f"SELECT round({_ap('smooth')}, {DIGITS}) AS pr_auc"))
def avg_precision(spark, sf):
    return rounded(metrics.average_precision(frames.scored(spark, sf), "label", "smooth"), "pr_auc")


@query(
    "threshold_sweep",
    oracle.sql(
        "scored",
        """SELECT s AS threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
                  CAST(tp AS DOUBLE) / CAST(tp + fp AS DOUBLE) AS "precision", CAST(tp AS DOUBLE) / CAST(all_pos AS DOUBLE) AS recall,
                  CAST(2 * tp AS DOUBLE) / CAST(tp + fp + all_pos AS DOUBLE) AS f1 FROM (
             SELECT s, sum(pos) OVER (ORDER BY s DESC) AS tp, sum(neg) OVER (ORDER BY s DESC) AS fp, sum(pos) OVER () AS all_pos FROM (
               SELECT smooth AS s, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY smooth))""",
    ),
)
def threshold_sweep(spark, sf):
    return metrics.threshold_sweep(frames.scored(spark, sf), "label", "smooth")


_ERROR = "(order_basket_value - order_order_total)"


@query(
    "reg_metrics",
    oracle.sql(
        "clean",
        f"""SELECT round(avg(abs({_ERROR})), {DIGITS}) AS mae, round(avg({_ERROR} * {_ERROR}), {DIGITS}) AS mse,
                   round(sqrt(avg({_ERROR} * {_ERROR})), {DIGITS}) AS rmse,
                   round(1 - avg({_ERROR} * {_ERROR}) / var_pop(order_basket_value), {DIGITS}) AS r2,
                   round(avg(abs({_ERROR}) / greatest(abs(order_basket_value), 2.220446049250313e-16)), {DIGITS}) AS mape FROM clean""",
    ),
)
def reg_metrics(spark, sf):
    out = metrics.regression_metrics(frames.clean_table(spark, sf), "order_basket_value", "order_order_total")
    return rounded(out, "mae", "mse", "rmse", "r2", "mape")


@query(
    "residual_summary",
    oracle.sql(
        "clean",
        f"""SELECT round(avg({_ERROR}), {DIGITS}) AS mean, round(stddev_pop({_ERROR}), {DIGITS}) AS std,
                   min({_ERROR}) AS min_value, max({_ERROR}) AS max_value FROM clean""",
    ),
)
def residual_summary(spark, sf):
    out = metrics.residual_summary(frames.clean_table(spark, sf), "order_basket_value", "order_order_total")
    return rounded(out, "mean", "std")
