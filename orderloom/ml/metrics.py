"""Model evaluation as aggregates over (label, score) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.operators import ranks
from orderloom.operators.reshape import rows_from, scalar_struct
from orderloom.session import materialise

# Fixed value: probabilities are kept this far from 0 and 1 in the log loss.
PROBABILITY_MARGIN = 2.220446049250313e-16


def _ratio(a: Column, b: Column) -> Column:
    """a / b as double, NULL when b is zero."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def _ratio0(a: Column, b: Column) -> Column:
    """a / b as double, 0 when undefined."""
    return F.coalesce(_ratio(a, b), F.lit(0.0))


def confusion(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """tn, fp, fn, tp at a threshold (score strictly above it counts as positive)."""
    y, p = F.col(label).cast("int") == 1, F.col(score) > F.lit(float(threshold))
    return df.agg(
        F.count_if(~y & ~p).alias("tn"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(y & p).alias("tp"),
    )


def _rates(tn: Column, fp: Column, fn: Column, tp: Column) -> dict[str, Column]:
    d = {n: c.cast("double") for n, c in (("tn", tn), ("fp", fp), ("fn", fn), ("tp", tp))}
    tn, fp, fn, tp = d["tn"], d["fp"], d["fn"], d["tp"]
    margins = F.sqrt(tp + fp) * F.sqrt(tp + fn) * F.sqrt(tn + fp) * F.sqrt(tn + fn)
    sensitivity, specificity = _ratio(tp, tp + fn), _ratio(tn, tn + fp)
    return {
        "accuracy": _ratio(tp + tn, tp + tn + fp + fn),
        "precision": _ratio0(tp, tp + fp),
        "recall": _ratio0(tp, tp + fn),
        "f1": _ratio0(2 * tp, 2 * tp + fp + fn),
        # Mean recall over the classes that occur.
        "balanced_accuracy": F.coalesce((sensitivity + specificity) / 2, sensitivity, specificity),
        "matthews_corrcoef": _ratio0(tp * tn - fp * fn, margins),
    }


def threshold_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    counts = confusion(df, label, score, threshold)
    rates = _rates(*[F.col(c) for c in ("tn", "fp", "fn", "tp")])
    return counts.select(*[c.alias(n) for n, c in rates.items()])


def probability_losses(df: DataFrame, label: str, score: str) -> DataFrame:
    """Log loss (scores clipped) and Brier score."""
    y, p = F.col(label).cast("double"), F.col(score)
    p_safe = F.least(F.greatest(p, F.lit(PROBABILITY_MARGIN)), F.lit(1.0 - PROBABILITY_MARGIN))
    loss = -F.when(y == 1.0, F.log(p_safe)).otherwise(F.log(1.0 - p_safe))
    return df.agg(F.avg(loss).alias("log_loss"), F.avg((p - y) * (p - y)).alias("brier_score"))


def score_curve(df: DataFrame, label: str, score: str) -> DataFrame:
    """Per distinct score: ``pos``/``neg`` there, ``upto_*`` at or above it, ``all_*`` in total.

    Rows are combined to distinct scores before anything is ordered.  That table is
    written once, because the running totals read it several times.
    """
    y = F.col(label).cast("int") == 1
    per_score = (
        df.where(F.col(score).isNotNull())
        .groupBy(F.col(score).cast("double").alias("score"))
        .agg(F.count_if(y).alias("pos"), F.count_if(~y).alias("neg"))
    )
    return ranks.running_totals(materialise(per_score, "scores"), "score", ["pos", "neg"], descending=True)


def ranking_metrics(df: DataFrame, label: str, score: str) -> DataFrame:
    """ROC AUC (ties count half) and average precision; NULL when one class is absent.

    With negatives counted from the top, a positive outranks all negatives but those
    at or above its score, and half of the tied ones.  The sums are exact integers.
    """
    curve = score_curve(df, label, score)
    ahead2 = (F.col("upto_neg") * 2 - F.col("neg")).cast("decimal(20,0)") * F.col("pos").cast("decimal(18,0)")
    gain = F.col("pos") * _ratio(F.col("upto_pos"), F.col("upto_pos") + F.col("upto_neg"))
    sums = curve.agg(
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
        F.sum(ahead2).alias("ahead2"),
        F.sum(gain).alias("gain"),
    )
    pairs2 = F.col("pos").cast("decimal(19,0)") * F.col("neg").cast("decimal(18,0)") * 2
    return sums.select(
        _ratio(pairs2 - F.col("ahead2"), pairs2).alias("roc_auc"),
        F.try_divide("gain", F.col("pos").cast("double")).alias("pr_auc"),
    )


def roc_auc(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking_metrics(df, label, score).select("roc_auc")


def average_precision(df: DataFrame, label: str, score: str) -> DataFrame:
    return ranking_metrics(df, label, score).select("pr_auc")


def classification_metrics(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """All classification metrics as one row."""
    ranked = scalar_struct(ranking_metrics(df, label, score))
    losses = scalar_struct(probability_losses(df, label, score))
    return threshold_metrics(df, label, score, threshold).select(
        "*",
        *[ranked[c].alias(c) for c in ("roc_auc", "pr_auc")],
        *[losses[c].alias(c) for c in ("log_loss", "brier_score")],
        F.lit(float(threshold)).alias("threshold"),
    )


def classification_report(df: DataFrame, label: str, score: str, threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 and support per class, with macro and weighted means."""
    counts = confusion(df, label, score, threshold)
    tn, fp, fn, tp = (F.col(c).cast("double") for c in ("tn", "fp", "fn", "tp"))

    def of_class(hit: Column, false_alarm: Column, miss: Column) -> dict[str, Column]:
        return {
            "precision": _ratio0(hit, hit + false_alarm),
            "recall": _ratio0(hit, hit + miss),
            "f1_score": _ratio0(2 * hit, 2 * hit + false_alarm + miss),
            "support": hit + miss,
        }

    zero, one = of_class(tn, fn, fp), of_class(tp, fp, fn)
    n = zero["support"] + one["support"]
    names = ("precision", "recall", "f1_score")
    macro = {m: (zero[m] + one[m]) / 2 for m in names} | {"support": n}
    weighted = {m: _ratio(zero[m] * zero["support"] + one[m] * one["support"], n) for m in names} | {"support": n}
    accuracy = _ratio(tp + tn, n)
    flat = {m: accuracy for m in names} | {"support": n}
    labelled = {"0": zero, "1": one, "accuracy": flat, "macro avg": macro, "weighted avg": weighted}
    return rows_from(counts, [{"class": F.lit(k)} | v for k, v in labelled.items()])


def threshold_sweep(df: DataFrame, label: str, score: str) -> DataFrame:
    """Precision, recall and F1 with every distinct score as the threshold (at or above)."""
    tp, fp, positives = F.col("upto_pos"), F.col("upto_neg"), F.col("all_pos")
    return score_curve(df, label, score).select(
        F.col("score").alias("threshold"),
        tp.alias("tp"),
        fp.alias("fp"),
        _ratio0(tp, tp + fp).alias("precision"),
        _ratio0(tp, positives).alias("recall"),
        _ratio0(2 * tp, tp + fp + positives).alias("f1"),
    )


def best_threshold(df: DataFrame, label: str, score: str, by: str = "f1") -> DataFrame:
    """The threshold with the best F1 (or other swept measure), smallest on ties."""
    swept = threshold_sweep(df, label, score)
    return swept.orderBy(F.col(by).desc(), F.col("threshold")).limit(1)


def regression_metrics(df: DataFrame, target: str, prediction: str) -> DataFrame:
    """MAE, MSE, RMSE, R2 and MAPE."""
    y, p = F.col(target).cast("double"), F.col(prediction).cast("double")
    error = y - p
    # MAPE divides by |y|, kept away from zero.
    relative = F.abs(error) / F.greatest(F.abs(y), F.lit(PROBABILITY_MARGIN))
    sums = df.agg(
        F.avg(F.abs(error)).alias("mae"),
        F.avg(error * error).alias("mse"),
        F.var_pop(y).alias("spread"),
        F.avg(relative).alias("mape"),
    )
    return sums.select(
        "mae",
        "mse",
        F.sqrt("mse").alias("rmse"),
        (1.0 - F.try_divide(F.col("mse"), F.col("spread"))).alias("r2"),
        "mape",
    )


def residual_summary(df: DataFrame, target: str, prediction: str) -> DataFrame:
    """Mean, population std, min and max of target minus prediction."""
    r = F.col(target).cast("double") - F.col(prediction).cast("double")
    return df.agg(
        F.avg(r).alias("mean"),
        F.stddev_pop(r).alias("std"),
        F.min(r).alias("min_value"),
        F.max(r).alias("max_value"),
    )
