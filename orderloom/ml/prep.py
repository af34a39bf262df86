"""Feature preparation: fitted once on training rows, replayed anywhere.

Order of steps: impute, clip to 1.5 IQR, booleans to 0/1, one-hot, scale, align.
The fitted state is a few numbers per column, kept as a model parameter, so the
same object serves batch and stream and is saved with any ML pipeline.
``pyspark.ml``'s own imputers, scalers and encoders are not used because their
quantiles are not interpolated, they reject text, and they drop another category.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.functions.numeric import clip
from orderloom.operators import ranks
from orderloom.operators.project import align_features
from orderloom.operators.reshape import melt

IQR_REACH = 1.5


# ---- single steps ----------------------------------------------------------


def fill(df: DataFrame, values: dict) -> DataFrame:
    """Missing values replaced by per-column constants."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in values.items() if v is not None})


def medians(df: DataFrame, columns: Iterable[str]) -> dict[str, float]:
    return ranks.medians(df, columns)


def most_frequent(df: DataFrame, columns: Iterable[str]) -> dict[str, str]:
    return ranks.modes_row(df, columns).first().asDict()


@dataclass
class Spread:
    """Quartile points of one column: prob -> (low, high, part), and how many values it has."""

    total: int
    points: dict[float, tuple[float, float, float]]

    def at(self, prob: float) -> float:
        return ranks.interpolate(*self.points[prob])

    def median(self) -> float:
        low, high, _ = self.points[0.5]
        return (low + high) / 2.0

    def limits(self) -> list[float]:
        q1, q3 = self.at(0.25), self.at(0.75)
        return [q1 - IQR_REACH * (q3 - q1), q3 + IQR_REACH * (q3 - q1)]

    def scale(self) -> list[float]:
        """[median, IQR]; a zero IQR counts as one."""
        return [self.median(), (self.at(0.75) - self.at(0.25)) or 1.0]

    def clipped(self) -> Spread:
        """The same points after clipping to the limits.

        Clipping never changes the order of values, so the order statistics of the
        clipped column are the clipped order statistics: no second pass is needed.
        """
        floor, ceiling = self.limits()
        cut = lambda v: max(min(v, ceiling), floor)
        return Spread(self.total, {p: (cut(lo), cut(hi), part) for p, (lo, hi, part) in self.points.items()})


def spreads(df: DataFrame, columns: Iterable[str]) -> dict[str, Spread]:
    """Quartile points of every column that has values, in one run."""
    return {c: Spread(total, points) for c, (total, points) in ranks.found_points(df, columns, [0.25, 0.5, 0.75]).items()}


def iqr_limits(df: DataFrame, columns: Iterable[str]) -> dict[str, list[float]]:
    """[Q1 - 1.5 IQR, Q3 + 1.5 IQR] per column."""
    return {c: s.limits() for c, s in spreads(df, columns).items()}


def clip_columns(df: DataFrame, limits: dict[str, list[float]]) -> DataFrame:
    return df.withColumns({c: clip(F.col(c), F.lit(lo), F.lit(hi)) for c, (lo, hi) in limits.items()})


def robust_scales(df: DataFrame, columns: Iterable[str]) -> dict[str, list[float]]:
    """[median, IQR] per column; a zero IQR counts as one."""
    return {c: s.scale() for c, s in spreads(df, columns).items()}


def standard_scales(df: DataFrame, columns: Iterable[str]) -> dict[str, list[float]]:
    """[mean, population std] per column; a zero std counts as one."""
    columns = list(columns)
    row = df.agg(
        *[F.avg(c).alias(f"{c}__mean") for c in columns],
        *[F.stddev_pop(c).alias(f"{c}__std") for c in columns],
    ).first()
    return {c: [row[f"{c}__mean"], row[f"{c}__std"] or 1.0] for c in columns if row[f"{c}__mean"] is not None}


def scale_columns(df: DataFrame, scales: dict[str, list[float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c) - F.lit(m)) / F.lit(s) for c, (m, s) in scales.items()})


def categories(df: DataFrame, columns: Iterable[str]) -> dict[str, list[str]]:
    """Sorted values per category column, all of them.

    The fit holds one string per value and encoding makes a column per value, so
    this is for columns that are categories.
    """
    columns = list(columns)
    rows = melt(df, columns, as_type="string").where(F.col("value").isNotNull()).distinct().collect()
    return {c: sorted(r["value"] for r in rows if r["column"] == c) for c in columns}


def _modes_and_categories(df: DataFrame, columns: list[str]) -> tuple[dict[str, str | None], dict[str, list[str]]]:
    """``most_frequent`` and ``categories`` from one count.  Filling gaps with the mode adds no value."""
    rows = melt(df, columns, as_type="string").where(F.col("value").isNotNull()).groupBy("column", "value").count().collect()
    counts: dict[str, dict[str, int]] = {c: {} for c in columns}
    for r in rows:
        counts[r["column"]][r["value"]] = r["count"]
    tops = {c: min(n, key=lambda v: (-n[v], v), default=None) for c, n in counts.items()}
    return tops, {c: sorted(n) for c, n in counts.items()}


def one_hot_columns(values: dict[str, list[str]], present: Iterable[str]) -> dict[str, Column]:
    """Indicator columns ``{column}_{value}`` for all but the first value.

    An unseen value matches nothing and becomes all zeros, as does a missing column.
    """
    present = set(present)
    return {
        f"{c}_{v}": F.when(F.col(c) == v, 1.0).otherwise(0.0) if c in present else F.lit(0.0)
        for c, vs in values.items()
        for v in vs[1:]
    }


def one_hot(df: DataFrame, values: dict[str, list[str]]) -> DataFrame:
    return df.withColumns(one_hot_columns(values, df.columns)).drop(*values)


# ---- clipping as an ML stage -------------------------------------------------


class _Columns(Params):
    inputCols = Param(Params._dummy(), "inputCols", "columns to treat", TypeConverters.toListString)


class _State(Params):
    state = Param(Params._dummy(), "state", "fitted values")


class IqrClipper(Estimator, _Columns, DefaultParamsReadable, DefaultParamsWritable):
    """Limits outliers of the input columns to 1.5 interquartile ranges."""

    @keyword_only
    def __init__(self, *, inputCols=None):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> IqrClipperModel:
        return IqrClipperModel()._set(state=iqr_limits(dataset, self.getOrDefault("inputCols")))


class IqrClipperModel(Model, _State, DefaultParamsReadable, DefaultParamsWritable):
    def _transform(self, dataset: DataFrame) -> DataFrame:
        present = set(dataset.columns)
        return clip_columns(dataset, {c: v for c, v in self.getOrDefault("state").items() if c in present})


# ---- the whole preparation ---------------------------------------------------


class OrderPrep(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits every preparation step on the training rows."""

    numericCols = Param(Params._dummy(), "numericCols", "numeric features", TypeConverters.toListString)
    categoryCols = Param(Params._dummy(), "categoryCols", "category features", TypeConverters.toListString)
    boolCols = Param(Params._dummy(), "boolCols", "boolean features", TypeConverters.toListString)
    scaler = Param(Params._dummy(), "scaler", "robust or standard", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoryCols=None, boolCols=None, scaler=None):
        super().__init__()
        self._setDefault(
            numericCols=list(schemas.NUMERIC_COLUMNS),
            categoryCols=list(schemas.CATEGORY_COLUMNS),
            boolCols=[],
            scaler="robust",
        )
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> OrderPrepModel:
        numeric, category = self.getOrDefault("numericCols"), self.getOrDefault("categoryCols")
        bools = self.getOrDefault("boolCols")
        typed = dataset.select(
            *[F.col(c).cast("double").alias(c) for c in numeric], *[F.col(c) for c in category]
        )
        spread = spreads(typed, numeric)
        modes, values = _modes_and_categories(typed, category) if category else ({}, {})
        fills = {c: s.median() for c, s in spread.items()} | modes
        filled = fill(typed, fills)
        # Filling moves the quartiles, but only of columns that had gaps.
        rows = typed.count()
        gaps = [c for c, s in spread.items() if s.total < rows]
        if gaps:
            spread |= spreads(filled, gaps)
        limits = {c: s.limits() for c, s in spread.items()}
        if self.getOrDefault("scaler") == "robust":
            scales = {c: s.clipped().scale() for c, s in spread.items()}
        else:
            scales = standard_scales(clip_columns(filled, limits), numeric)
        hot = [f"{c}_{v}" for c, vs in values.items() for v in vs[1:]]
        state = {
            "numeric": numeric,
            "bools": bools,
            "fills": fills,
            "limits": limits,
            "scales": scales,
            "categories": values,
            "features": [*numeric, *bools, *hot],
        }
        return OrderPrepModel()._set(state=state)


class OrderPrepModel(Model, _State, DefaultParamsReadable, DefaultParamsWritable):
    """Replays the fitted steps.  Columns that are no features pass through."""

    @property
    def features(self) -> list[str]:
        return self.getOrDefault("state")["features"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s = self.getOrDefault("state")
        present = set(dataset.columns)
        numeric = [c for c in s["numeric"] if c in present]
        bools = [c for c in s["bools"] if c in present]
        category = [c for c in s["categories"] if c in present]
        df = dataset.withColumns({c: F.col(c).cast("double") for c in numeric})
        df = fill(df, {c: s["fills"].get(c) for c in [*numeric, *category]})
        df = clip_columns(df, {c: s["limits"][c] for c in numeric if c in s["limits"]})
        df = df.withColumns({c: F.col(c).cast("double") for c in bools})
        df = one_hot(df, s["categories"])
        df = scale_columns(df, {c: s["scales"][c] for c in numeric if c in s["scales"]})
        kept = [c for c in dataset.columns if c not in {*s["features"], *s["categories"]}]
        return align_features(df, s["features"], keep=kept)


def feature_audit(train: DataFrame, test: DataFrame, features: Iterable[str]) -> DataFrame:
    """Missing values in both feature frames, agreement of columns, constant features."""
    features = list(features)

    def audit(df: DataFrame, side: str) -> DataFrame:
        missing = [F.count_if(F.col(c).isNull() | F.isnan(c)) for c in features]
        constant = [F.when(F.min(c) == F.max(c), 1).otherwise(0) for c in features]
        return df.agg(
            F.lit(side).alias("side"),
            sum(missing[1:], missing[0]).alias("n_missing"),
            F.lit(list(train.columns) == list(test.columns)).alias("same_columns"),
            sum(constant[1:], constant[0]).alias("n_constant"),
        )

    return audit(train, "train").unionByName(audit(test, "test"))
