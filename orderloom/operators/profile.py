"""Profiling reports: counts, missing values, distributions, correlations.

Each report is one pass of map-side-combined aggregates, reshaped afterwards.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.ml.feature import VectorAssembler
from pyspark.mllib.linalg.distributed import RowMatrix
from pyspark.mllib.util import MLUtils
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions import numeric, orders
from orderloom.operators import ranks
from orderloom.operators.project import column_report
from orderloom.operators.relational import any_null
from orderloom.operators.reshape import melt, rows_from

QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table."""
    counts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")) for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def table_profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Column report of every table, with its row count."""
    reports = [
        column_report(df.withColumn("__row", F.lit(1)))
        .select(F.lit(name).alias("table_name"), "*")
        for name, df in tables.items()
    ]
    merged = reduce(DataFrame.unionByName, reports)
    totals = merged.where(F.col("column") == "__row").select("table_name", F.col("non_null").alias("row_count"))
    return merged.where(F.col("column") != "__row").join(F.broadcast(totals), "table_name")  # a row per table


def na_report(df: DataFrame) -> DataFrame:
    """Missing values per column, count and percentage, worst first."""
    counts = df.agg(
        F.count(F.lit(1)).alias("__n"), *[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns]
    )
    share = lambda c: F.try_divide(F.col(c).cast("double"), F.col("__n").cast("double")) * 100.0
    rows = [{"column": F.lit(c), "na_count": F.col(c), "na_pct": share(c)} for c in df.columns]
    return rows_from(counts, rows).orderBy(F.col("na_count").desc(), "column")


def na_any(df: DataFrame) -> DataFrame:
    """Columns with any missing value (named) and rows with any."""
    flags = df.agg(
        F.count_if(any_null(df.columns)).alias("rows_with_na"),
        *[F.bool_or(F.col(c).isNull()).alias(f"__{c}") for c in df.columns],
    )
    names = F.array_compact(F.array(*[F.when(F.col(f"__{c}"), F.lit(c)) for c in sorted(df.columns)]))
    return flags.select(F.concat_ws(",", names).alias("columns_with_na"), "rows_with_na")


def distinct_profile(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Per column: distinct values with and without NULL, and missing values.

    Counted from (column, value) pairs, so the keys spread over all tasks.
    """
    pairs = melt(df, columns, as_type="string").groupBy("column", "value").agg(F.count(F.lit(1)).alias("n"))
    return pairs.groupBy("column").agg(
        F.count(F.lit(1)).alias("n_distinct_with_null"),
        F.count("value").alias("n_distinct"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(F.lit(0))).alias("n_null"),
    )


def value_counts(df: DataFrame, column: str, top: int | None = None, by_value: bool = False) -> DataFrame:
    """Frequency of each value, NULL included; most frequent first, or by value."""
    counts = df.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    order = [F.col("value")] if by_value else [F.col("n").desc(), F.col("value").asc_nulls_last()]
    ordered = counts.orderBy(*order)
    return ordered.limit(top) if top else ordered


def describe_numeric(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """count, mean, sample std, min, exact quartiles and max per numeric column."""
    columns = list(columns)
    x = {c: F.col(c).cast("double") for c in columns}
    moments = df.agg(
        *[
            f.alias(f"{c}__{name}")
            for c in columns
            for name, f in (
                ("n", F.count(x[c])),
                ("mean", F.avg(x[c])),
                ("std", F.stddev_samp(x[c])),
                ("min", F.min(x[c])),
                ("max", F.max(x[c])),
            )
        ]
    )
    keys = {"n": "n_values", "mean": "mean", "std": "std", "min": "min_value", "max": "max_value"}
    rows = [{"column": F.lit(c)} | {out: F.col(f"{c}__{k}") for k, out in keys.items()} for c in columns]
    quartiles = ranks.quantiles_wide(df, columns, QUARTILES)
    return rows_from(moments, rows).join(F.broadcast(quartiles), "column", "left")  # a row per column


def describe_categorical(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """count, unique, top (smallest on ties) and freq per text or boolean column."""
    pairs = (
        melt(df, columns, as_type="string")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return pairs.groupBy("column").agg(
        F.sum("n").alias("n_values"),
        F.count(F.lit(1)).alias("n_unique"),
        F.min_by("value", F.struct(-F.col("n"), F.col("value"))).alias("top"),
        F.max("n").alias("freq"),
    )


def iqr_bounds(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Q1, Q3 and the interquartile range per column."""
    wide = ranks.quantiles_wide(df, columns, {"q1": 0.25, "q3": 0.75})
    return wide.withColumn("iqr", F.col("q3") - F.col("q1"))


def duplicate_counts(df: DataFrame, key: str) -> DataFrame:
    """Surplus exact copies, and surplus rows per key among the distinct rows.

    Rows are collapsed first, then keys: two plain aggregations that combine on
    the map side, whatever the number of copies of one row.
    """
    rows = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("__copies"))
    keys = rows.groupBy(key).agg(F.sum("__copies").alias("__all"), F.count(F.lit(1)).alias("__rows"))
    return keys.agg(
        (F.sum("__all") - F.sum("__rows")).alias("exact_duplicates"),
        (F.sum("__rows") - F.count(F.lit(1))).alias("key_duplicates"),
    )


def quality_checks(df: DataFrame, non_negative: Iterable[str], required: Iterable[str]) -> DataFrame:
    """Business-rule counters, one row per check."""
    checks = {f"{c}_negative": F.col(c) < 0 for c in non_negative}
    checks |= {f"{c}_missing": F.col(c).isNull() for c in required}
    counts = df.agg(*[F.count_if(cond).alias(name) for name, cond in checks.items()])
    return rows_from(counts, [{"check_name": F.lit(n), "n": F.col(n)} for n in checks])


def key_unique(df: DataFrame, key: str) -> DataFrame:
    """Row count, distinct keys, and whether the key is unique."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.sum("n").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        (F.sum("n") == F.count(F.lit(1))).alias("is_unique"),
    )


def total_columns() -> tuple[Column, Column]:
    """(expected total, delta) of an order row."""
    parts = (F.col("order_basket_value"), F.col("order_shipping_fee"), F.col("order_discount"))
    return orders.expected_total(*parts), orders.total_delta(F.col("order_order_total"), *parts)


def total_consistency(df: DataFrame) -> DataFrame:
    """Add the expected total, its difference to the given one, and the flag."""
    expected, delta = total_columns()
    return df.withColumns(
        {
            "order_total_expected": expected,
            "order_total_delta": delta,
            "order_total_inconsistent": orders.is_inconsistent(delta),
        }
    )


def inconsistent_totals(df: DataFrame) -> DataFrame:
    return total_consistency(df).where("order_total_inconsistent")


def total_repair(df: DataFrame) -> DataFrame:
    parts = (F.col("order_basket_value"), F.col("order_shipping_fee"), F.col("order_discount"))
    return df.withColumn("order_order_total", orders.repaired_total(F.col("order_order_total"), *parts))


def total_check_counts(df: DataFrame) -> DataFrame:
    _, delta = total_columns()
    return df.agg(
        F.count_if(F.col("order_order_total").isNull()).alias("missing_totals"),
        F.count_if(orders.is_inconsistent(delta)).alias("inconsistent_totals"),
    )


#: Variance (of standardised values) up to which a column counts as constant on the rows of a pair.
_CONSTANT = 1e-12


def correlation_matrix(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Pearson correlation of every column pair, missing values (NaN too) dropped pairwise.

    Two reads of the columns: one for their means and deviations, one for the Gram matrix of (value, is there, value squared), whose
    entries are all the pairwise counts, sums and products.  Rows become vectors and are added up inside their task; a task
    sends one matrix of (3 x columns) squared, and nothing is fanned out.  Values are standardised first, so squares do not
    cancel.  A column that is constant, also only on the rows of a pair, gives NULL.
    """
    columns = list(columns)
    names = "x string, y string, r double"
    if not columns:
        return df.sparkSession.createDataFrame([], names)
    value = {c: F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")) for c in columns}
    figures = [f(value[c]).alias(f"{k}{i}") for i, c in enumerate(columns) for k, f in _SHAPE.items()]
    shape = df.agg(F.count(F.lit(1)).alias("rows"), *figures).first().asDict()
    if not shape["rows"]:
        return df.sparkSession.createDataFrame([(a, b, None) for a in columns for b in columns], names)
    cells = []
    for i, c in enumerate(columns):
        # A constant is taken off exactly.
        constant = shape[f"low{i}"] == shape[f"high{i}"]
        middle = shape[f"low{i}"] if constant else shape[f"mean{i}"]
        z = (value[c] - F.lit(middle or 0.0)) / F.lit(1.0 if constant else shape[f"std{i}"] or 1.0)
        cells.append((F.coalesce(z, F.lit(0.0)).alias(f"z{i}"), value[c].isNotNull().cast("double").alias(f"m{i}")))
    held = df.select(*[x for pair in cells for x in pair])
    held = held.withColumns({f"q{i}": F.col(f"z{i}") * F.col(f"z{i}") for i in range(len(columns))})
    order = [f"{k}{i}" for k in "zmq" for i in range(len(columns))]
    rows = VectorAssembler(inputCols=order, outputCol="row").transform(held).select("row")
    gram = RowMatrix(MLUtils.convertVectorColumnsFromML(rows, "row"), 0, len(order)).computeGramianMatrix().toArray()
    n = len(columns)
    zz, zm, mm, qm = gram[:n, :n], gram[:n, n : 2 * n], gram[n : 2 * n, n : 2 * n], gram[2 * n :, n : 2 * n]
    found = []
    for i, a in enumerate(columns):
        for j, b in enumerate(columns):
            count, r = mm[i, j], None
            if count:
                # Sums of squares about the means of the pair's own rows.
                xx, yy = qm[i, j] - zm[i, j] ** 2 / count, qm[j, i] - zm[j, i] ** 2 / count
                if min(xx, yy) > _CONSTANT * count:
                    r = float((zz[i, j] - zm[i, j] * zm[j, i] / count) / math.sqrt(xx * yy))
            found.append((a, b, r))
    return df.sparkSession.createDataFrame(found, names)


_SHAPE = {"mean": F.avg, "std": F.stddev_pop, "low": F.min, "high": F.max}


def histogram(df: DataFrame, column: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over [min, max], last bin closed, empty bins included."""
    x = F.col(column).cast("double")
    bounds = ranks.scalar_bounds(df, column)
    low, high = bounds["low"], bounds["high"]
    number = F.when(high > low, F.least(F.floor((x - low) / (high - low) * bins), F.lit(bins - 1))).otherwise(0)
    counts = df.where(x.isNotNull()).groupBy(number.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    all_bins = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = (high - low) / bins
    return all_bins.join(F.broadcast(counts), "bin", "left").select(  # at most `bins` rows
        "bin",
        (low + width * F.col("bin")).alias("bin_low"),
        (low + width * (F.col("bin") + 1)).alias("bin_high"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def boxplot(df: DataFrame, column: str) -> DataFrame:
    """Quartiles, whiskers at the last points within 1.5 IQR, and outliers beyond."""
    x = F.col(column).cast("double")
    quartiles = ranks.quantiles_wide(df, [column], QUARTILES).drop("column")
    q = quartiles.select(F.struct("*").alias("q")).scalar()
    reach = (q["q75"] - q["q25"]) * 1.5
    inside = x.between(q["q25"] - reach, q["q75"] + reach)
    return df.select(x.alias("x"), inside.alias("inside"), q.alias("q")).agg(
        F.any_value("q").alias("q"),
        F.min(F.when(F.col("inside"), F.col("x"))).alias("whisker_low"),
        F.max(F.when(F.col("inside"), F.col("x"))).alias("whisker_high"),
        F.count_if(~F.col("inside")).alias("n_outliers"),
    ).select("q.*", "whisker_low", "whisker_high", "n_outliers")


def relation(df: DataFrame, x: str, y: str) -> DataFrame:
    """Distribution of ``y`` at each value of ``x`` (what a scatter plot shows)."""
    counts = df.groupBy(x).agg(
        F.count(F.lit(1)).alias("n"),
        F.avg(F.col(y)).alias("mean"),
        F.min(F.col(y).cast("double")).alias("min_value"),
        F.max(F.col(y).cast("double")).alias("max_value"),
    )
    quartiles = ranks.quantiles_wide(df, [y], QUARTILES, by=[x]).drop("column")
    return counts.join(quartiles.withColumnRenamed(x, "__x"), F.col(x).eqNullSafe(F.col("__x")), "left").drop("__x")


def target_summary(df: DataFrame, target: str) -> DataFrame:
    x = F.col(target)
    return df.agg(
        F.avg(x).alias("mean"),
        F.stddev_samp(x).alias("std"),
        F.min(x).alias("min_value"),
        F.max(x).alias("max_value"),
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Positive rate and class sizes of a 0/1 or boolean label."""
    y = F.col(label).cast("int")
    return df.agg(
        F.try_divide(F.sum(y).cast("double"), F.count(y).cast("double")).alias("positive_rate"),
        F.count_if(y == 1).alias("n_positive"),
        F.count_if(y == 0).alias("n_negative"),
    )


# ---- business queries ------------------------------------------------------


def _rate(c: Column) -> Column:
    y = c.cast("int")
    return F.try_divide(F.sum(y).cast("double"), F.count(y).cast("double"))


def return_rate(df: DataFrame) -> DataFrame:
    return df.agg(_rate(F.col("order_is_returned")).alias("return_rate"), F.count(F.lit(1)).alias("n"))


def return_rate_by(df: DataFrame, column: str) -> DataFrame:
    rates = df.groupBy(column).agg(
        _rate(F.col("order_is_returned")).alias("return_rate"), F.count(F.lit(1)).alias("n")
    )
    return rates.orderBy(F.col("return_rate").desc(), F.col(column).asc_nulls_last())


def revenue_by(df: DataFrame, column: str) -> DataFrame:
    sums = df.groupBy(column).agg(numeric.money_sum(F.col("order_order_total")).alias("revenue"))
    return sums.orderBy(F.col("revenue").desc(), F.col(column).asc_nulls_last())


def per_day(df: DataFrame, time_col: str, measures: Mapping[str, Column], empty: Mapping[str, Column]) -> DataFrame:
    """One row per calendar day between the first and last event; empty days get ``empty``.

    Each day's row also stands for the empty days up to the next one, so the input is read once and nothing is joined.
    The window is over one row per day.
    """
    days = (
        df.where(F.col(time_col).isNotNull())
        .groupBy(F.to_date(time_col).alias("first"))
        .agg(*[m.alias(n) for n, m in measures.items()])
    )
    following = F.coalesce(F.date_sub(F.lead("first").over(Window.orderBy("first")), 1), F.col("first"))
    reach = days.withColumn("last", following)
    spread = reach.select("*", F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day"))
    here = F.col("day") == F.col("first")
    return spread.select("day", *[F.when(here, F.col(n)).otherwise(empty[n]).alias(n) for n in measures])


def daily_events(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    return per_day(df, time_col, {"n_events": F.count(F.lit(1))}, {"n_events": F.lit(0)})


def daily_revenue(df: DataFrame, time_col: str = "event_time") -> DataFrame:
    revenue = numeric.money_sum(F.col("order_order_total"))
    return per_day(df, time_col, {"revenue": revenue}, {"revenue": F.lit(0.0)})
