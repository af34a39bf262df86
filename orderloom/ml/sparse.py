"""One-hot encoding of columns with very many values, as sparse vectors.

``prep.one_hot`` makes a column per value, which is right for a handful of categories.  Here the values of a column are numbered in a stored
table (column, value, slot), rows get their slot by a join on the value, and a vector holds the one slot that is set.  Nothing
is collected: the driver only learns how many slots each column has.  The rules are the same: the alphabetically first value is the
base, and a base, unseen or missing value is all zeros.

A column's part of the table is a folder of its own, so Spark knows its true size when it plans the join: small ones are broadcast, and for large ones rows
are shuffled by value, where a value that owns a third of the rows is split (the table has one row a value).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderloom import schemas
from orderloom.ml import prep
from orderloom.operators import ranks
from orderloom.operators.reshape import melt
from orderloom.session import shared_dir


def build_index(df: DataFrame, columns: Iterable[str], path: str) -> dict[str, int]:
    """Number the values of each column but its first, in their order, and store them under ``path``; returns the slots per column."""
    columns = list(columns)
    values = melt(df, columns, as_type="string").where(F.col("value").isNotNull()).distinct()
    placed = ranks.positions(values, ["column", "value"], "place")
    first = placed.groupBy("column").agg(F.min("place").alias("base"))  # a row per column
    slots = placed.join(F.broadcast(first), "column").where(F.col("place") > F.col("base"))
    slots = slots.select("column", "value", (F.col("place") - F.col("base") - 1).alias("slot"))
    slots.repartition("column", F.pmod(F.xxhash64("value"), F.lit(16))).write.partitionBy("column").parquet(path)
    sizes = read_index(df.sparkSession, path).groupBy("column").count()
    return dict.fromkeys(columns, 0) | {r["column"]: r["count"] for r in sizes.collect()}  # a row per column


def read_index(spark: SparkSession, path: str, column: str | None = None) -> DataFrame:
    """The stored numbers: ``(value, slot, column)``, or ``(value, slot)`` of one column."""
    table = spark.read.schema("value string, slot bigint, column string").parquet(path)
    return table if column is None else table.where(F.col("column") == column).drop("column")


def slots(df: DataFrame, columns: Iterable[str], path: str, suffix: str = "_slot") -> DataFrame:
    """Adds ``{column}{suffix}``: the number of the row's value, NULL for a base, unseen or missing value."""
    for c in columns:
        index = read_index(df.sparkSession, path, c).select(F.col("value").alias("__value"), F.col("slot").alias(f"{c}{suffix}"))
        df = df.join(index, F.col(c).cast("string") == F.col("__value"), "left").drop("__value")
    return df


def feature_names(spark: SparkSession, numeric: Iterable[str], columns: Iterable[str], sizes: dict[str, int], path: str) -> DataFrame:
    """``(place, feature)`` of every place in the vector."""
    numeric, columns = list(numeric), list(columns)
    names = spark.createDataFrame(list(enumerate(numeric)), "place bigint, feature string")
    start = len(numeric)
    for c in columns:
        index = read_index(spark, path, c)
        names = names.unionByName(index.select((F.col("slot") + start).alias("place"), F.concat(F.lit(f"{c}_"), "value").alias("feature")))
        start += sizes[c]
    return names


class SparsePrep(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits imputation, clipping and scaling like ``prep.OrderPrep``, and numbers the categories in a table at ``indexPath``.

    The table belongs to the fitted model: keep it where every later session can read it.
    """

    numericCols = Param(Params._dummy(), "numericCols", "numeric features", TypeConverters.toListString)
    categoryCols = Param(Params._dummy(), "categoryCols", "category features of any size", TypeConverters.toListString)
    scaler = Param(Params._dummy(), "scaler", "robust or standard", TypeConverters.toString)
    indexPath = Param(Params._dummy(), "indexPath", "folder of the category table", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, numericCols=None, categoryCols=None, scaler=None, indexPath=None):
        super().__init__()
        self._setDefault(numericCols=list(schemas.NUMERIC_COLUMNS), categoryCols=list(schemas.CATEGORY_COLUMNS), scaler="robust")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _fit(self, dataset: DataFrame) -> SparsePrepModel:
        numeric, category = self.getOrDefault("numericCols"), self.getOrDefault("categoryCols")
        path = self.getOrDefault("indexPath") if self.isDefined("indexPath") else shared_dir(dataset.sparkSession, "categories")
        plain = prep.OrderPrep(numericCols=numeric, categoryCols=[], scaler=self.getOrDefault("scaler")).fit(dataset)
        # The most frequent value stands in for a missing one.
        modes = prep.most_frequent(dataset, category) if category else {}
        sizes = build_index(prep.fill(dataset.select(*category), modes), category, path) if category else {}
        state = {"numeric": plain.getOrDefault("state"), "modes": modes, "sizes": sizes, "path": path}
        return SparsePrepModel()._set(state=state)


class SparsePrepModel(Model, prep._State, DefaultParamsReadable, DefaultParamsWritable):
    """Adds ``features``, a sparse vector of the scaled numbers and the categories; other columns pass through."""

    @property
    def size(self) -> int:
        s = self.getOrDefault("state")
        return len(s["numeric"]["features"]) + sum(s["sizes"].values())

    def names(self, spark: SparkSession) -> DataFrame:
        s = self.getOrDefault("state")
        return feature_names(spark, s["numeric"]["features"], s["sizes"], s["sizes"], s["path"])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        s, spark = self.getOrDefault("state"), dataset.sparkSession
        numeric, sizes = s["numeric"]["features"], {c: n for c, n in s["sizes"].items() if n}
        whole = dataset.withColumns({c: F.lit(None).cast("string") for c in sizes if c not in dataset.columns})
        # A column that is not there is all zeros, as an unseen value is.
        filled = prep.fill(whole, {c: v for c, v in s["modes"].items() if c in dataset.columns})
        # The numbers are scaled under names of their own, so the columns themselves stay as they are.
        copies = filled.withColumns({f"__{c}": F.col(c) if c in dataset.columns else F.lit(None).cast("double") for c in numeric})
        scaled = prep.OrderPrepModel()._set(state=_renamed(s["numeric"])).transform(copies)
        met = slots(scaled, sizes, s["path"], "__slot")
        # Rows without a slot get the number past the last one, which the encoder drops: all zeros.
        met = met.withColumns({f"{c}__slot": F.coalesce(f"{c}__slot", F.lit(n)).cast("double") for c, n in sizes.items()})
        parts = [f"__{c}" for c in numeric]
        if sizes:
            encoder = OneHotEncoder(inputCols=[f"{c}__slot" for c in sizes], outputCols=[f"{c}__vector" for c in sizes], dropLast=True)
            largest = spark.createDataFrame([tuple(float(n) for n in sizes.values())], [f"{c}__slot" for c in sizes])
            met = encoder.fit(largest).transform(met)
            parts += [f"{c}__vector" for c in sizes]
        out = VectorAssembler(inputCols=parts, outputCol="features").transform(met)
        return out.select(*[c for c in dataset.columns if c != "features"], "features")


def _renamed(state: dict) -> dict:
    """The numeric steps for columns under their working names."""
    by = lambda d: {f"__{c}": v for c, v in d.items()}
    every = [f"__{c}" for c in state["features"]]
    return state | {"numeric": every, "features": every} | {k: by(state[k]) for k in ("fills", "limits", "scales")}
