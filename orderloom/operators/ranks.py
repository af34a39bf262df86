"""Exact order statistics without gathering the values in one task.

``percentile``/``median`` and an un-partitioned window both move every distinct
value through a single task.  The operators here narrow down by ranges instead:
each pass only shuffles per-range counts, whose number is bounded by the fan-out,
and only the few ranges that hold a wanted rank are looked at more closely.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.functions.numeric import nan_to_null
from orderloom.operators.reshape import melt
from orderloom.session import materialise

FANOUT = 4096
_RANGES_PER_OCTAVE = 32
#: Sketches of this size miss a rank by some 0.2 % of the rows; what they bracket reaches 1 % to either side of it.
SKETCH_SIZE = 2048
SKETCH_REACH = 0.01
#: With fewer values the reach is a handful of ranks, and the ranges are as cheap.
SKETCHED_FROM = 10_000


def _coarse_range(x: Column) -> Column:
    """A monotone, data-independent range number on a symmetric log scale."""
    return F.signum(x) * F.rint(F.log1p(F.abs(x)) * _RANGES_PER_OCTAVE)


def _fine_range(x: Column, low: Column, high: Column, fanout: int) -> Column:
    """Equal-width range number of ``x`` inside [low, high]."""
    step = F.floor((x - low) / (high - low) * fanout)
    return F.when(high > low, F.least(step, F.lit(fanout - 1))).otherwise(F.lit(0))


def _wanted_ranks(total: Column, probs: Iterable[float]) -> Column:
    """0-based ranks on either side of each interpolation point."""
    position = [F.lit(float(p)) * (total - 1) for p in probs]
    ranks = [f(p).cast("bigint") for p in position for f in (F.floor, F.ceil)]
    return F.array_distinct(F.array(*ranks))


def _ranges_with_wanted(counts: DataFrame, group: list[str], within: list[str], order: str, pick) -> DataFrame:
    """Keep the ranges that contain a wanted rank, with the ranks they hold.

    ``counts`` has one row per range (bounded by groups x fan-out): rows_in, low,
    high, and on later passes ``base`` (rows before the enclosing range), ``wanted``
    (ranks it holds) and ``total`` (rows in the group).
    """
    part = Window.partitionBy(*group, *within)
    running = part.orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    base = F.col("base") if within else F.lit(0)
    total = F.col("total") if within else F.sum("rows_in").over(part)
    wanted = F.col("wanted") if within else pick(total)
    placed = counts.select(
        *group,
        "low",
        "high",
        total.alias("total"),
        wanted.alias("all_wanted"),
        (base + F.sum("rows_in").over(running)).alias("upto"),
        "rows_in",
    )
    start = F.col("upto") - F.col("rows_in")
    inside = F.filter("all_wanted", lambda k: (k >= start) & (k < F.col("upto")))
    ranges = placed.select(*group, "low", "high", "total", start.alias("base"), inside.alias("wanted"))
    return ranges.where(F.size("wanted") > 0)


def _join_ranges(values: DataFrame, ranges: DataFrame, group: list[str], by: list[str]) -> DataFrame:
    # Without grouping columns there are at most 2 x columns x probabilities
    # ranges, so broadcasting is bounded.  With them the number of groups decides:
    # the ranges are written, so Spark plans with their true size, and the values
    # are shuffled only if the ranges are too large to be broadcast.
    side = ranges.withColumnsRenamed({g: f"of_{g}" for g in group})
    side = materialise(side, "ranges") if by else F.broadcast(side)
    condition = F.col("value").between(F.col("low"), F.col("high"))
    for g in group:
        condition = condition & F.col(g).eqNullSafe(F.col(f"of_{g}"))
    return values.join(side, condition).drop(*[f"of_{g}" for g in group])


def order_statistics(
    df: DataFrame,
    columns: Iterable[str],
    pick: Callable[[Column], Column],
    by: Iterable[str] = (),
    refinements: int = 1,
    fanout: int = FANOUT,
) -> DataFrame:
    """Values at chosen ranks: rows ``(by..., column, total, rank_no, value)``.

    ``pick`` turns the number of values of a group into an array of 0-based ranks.
    """
    columns, by = list(columns), list(by)
    group = [*by, "column"]
    # Adding 0.0 folds -0.0 into 0.0.
    values = melt(df, columns, by).where(F.col("value").isNotNull() & ~F.isnan("value"))
    values = values.withColumn("value", F.col("value") + F.lit(0.0))

    measures = [
        F.count(F.lit(1)).alias("rows_in"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    ]
    counts = values.groupBy(*group, _coarse_range(F.col("value")).alias("range_no")).agg(*measures)
    ranges = _ranges_with_wanted(counts, group, [], "range_no", pick)
    return _ranked(values, ranges, by, refinements, fanout)


def _ranked(values: DataFrame, ranges: DataFrame, by: list[str], refinements: int = 1, fanout: int = FANOUT) -> DataFrame:
    """The values at the ranks that ``ranges`` hold, as rows ``(by..., column, total, rank_no, value)``."""
    group = [*by, "column"]
    measures = [
        F.count(F.lit(1)).alias("rows_in"),
        F.min("value").alias("low"),
        F.max("value").alias("high"),
    ]
    outer = ["outer_low", "outer_high", "total", "base", "wanted"]
    for _ in range(refinements):
        held = (
            _join_ranges(values, ranges, group, by)
            .withColumnRenamed("low", "outer_low")
            .withColumnRenamed("high", "outer_high")
        )
        number = _fine_range(F.col("value"), F.col("outer_low"), F.col("outer_high"), fanout)
        counts = held.groupBy(*group, *outer, number.alias("range_no")).agg(*measures)
        ranges = _ranges_with_wanted(counts, group, outer, "range_no", None)

    held = _join_ranges(values, ranges, group, by)
    last = [*group, "low", "high", "total", "base", "wanted"]
    distinct = held.groupBy(*last, "value").agg(F.count(F.lit(1)).alias("rows_in"))
    running = (
        Window.partitionBy(*last)
        .orderBy("value")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    upto = F.col("base") + F.sum("rows_in").over(running)
    here = F.filter("wanted", lambda k: (k >= F.col("upto") - F.col("rows_in")) & (k < F.col("upto")))
    return (
        distinct.withColumn("upto", upto)
        .withColumn("rank_no", F.explode(here))
        .select(*group, "total", "rank_no", "value")
    )


def interpolate(low, high, part):
    """Between two neighbouring order statistics, from the nearer one (floats)."""
    return high - (high - low) * (1.0 - part) if part >= 0.5 else low + (high - low) * part


def quantile_points(
    df: DataFrame, columns: Iterable[str], probs: Iterable[float], by: Iterable[str] = (), **options
) -> DataFrame:
    """What each quantile is interpolated from: ``(by..., column, total, prob, low, high, part)``."""
    probs, by = [float(p) for p in probs], list(by)
    group = [*by, "column"]
    hits = order_statistics(df, columns, lambda total: _wanted_ranks(total, probs), by, **options)
    # A handful of order statistics per group remain.
    found = hits.groupBy(*group, "total").agg(
        F.map_from_entries(F.collect_list(F.struct("rank_no", "value"))).alias("at")
    )
    spread = found.withColumn("prob", F.explode(F.array(*[F.lit(p) for p in probs])))
    position = F.col("prob") * (F.col("total") - 1)
    floor_rank = F.floor(position).cast("bigint")
    return spread.select(
        *group,
        "total",
        "prob",
        F.element_at("at", floor_rank).alias("low"),
        F.element_at("at", F.ceil(position).cast("bigint")).alias("high"),
        (position - floor_rank).alias("part"),
    )


def found_points(
    df: DataFrame, columns: Iterable[str], probs: Iterable[float]
) -> dict[str, tuple[int, dict[float, tuple[float, float, float]]]]:
    """What ``quantile_points`` has, found at once: per column its number of values and ``prob -> (low, high, part)``.

    ``order_statistics`` makes a row of every value in each of its passes.  Here a sketch brackets the wanted ranks, one
    aggregation counts what lies below and up to each bracket, and only values inside the brackets become rows and are
    ranked.  The counts decide: a column whose ranks the sketch missed, or that has few values, goes the other way.
    A column without values is left out.  Some numbers per column and probability reach the driver.
    """
    columns, probs = list(columns), [float(p) for p in probs]
    names = {f"v{i}": c for i, c in enumerate(columns)}
    typed = df.select(*[(nan_to_null(F.col(c).cast("double")) + F.lit(0.0)).alias(v) for v, c in names.items()])
    totals, brackets = _bracket(typed, list(names), probs)
    totals = {v: n for v, n in totals.items() if n}
    wanted = {v: {p: (math.floor(p * (n - 1)), math.ceil(p * (n - 1))) for p in probs} for v, n in totals.items()}

    sketched = [v for v, n in totals.items() if n >= SKETCHED_FROM]
    at: dict[str, dict[int, float]] = {v: {} for v in totals}
    held: dict[tuple[str, float, float], tuple[int, set[int]]] = {}
    for (v, p), (low, high, below, past_low, to_high, upto) in _counted(typed, {k: b for k, b in brackets.items() if k[0] in sketched}).items():
        # Frequent values are mostly the ends themselves.
        at[v] |= {k: low for k in wanted[v][p] if below <= k < past_low} | {k: high for k in wanted[v][p] if to_high <= k < upto}
        between = {k for k in wanted[v][p] if past_low <= k < to_high}
        if between:
            held.setdefault((v, low, high), (below, set()))[1].update(between)
    if held:
        rows = [(v, low, high, totals[v], below, sorted(ranks)) for (v, low, high), (below, ranks) in held.items()]
        ranges = df.sparkSession.createDataFrame(rows, "column string, low double, high double, total bigint, base bigint, wanted array<bigint>")
        inside = {v: reduce(or_, [F.col(v).between(low, high) for of, low, high in held if of == v]) for v, _, _ in held}
        few = typed.where(reduce(or_, inside.values())).select(*[F.when(c, F.col(v)).alias(v) for v, c in inside.items()])
        values = melt(few, list(inside)).where(F.col("value").isNotNull())
        for r in _ranked(values, ranges, []).collect():
            at[r["column"]][r["rank_no"]] = r["value"]

    left = [v for v in totals if any(k not in at[v] for ends in wanted[v].values() for k in ends)]
    if left:
        for r in order_statistics(typed, left, lambda total: _wanted_ranks(total, probs)).collect():
            at[r["column"]][r["rank_no"]] = r["value"]
    return {
        names[v]: (n, {p: (at[v][lo], at[v][hi], p * (n - 1) - lo) for p, (lo, hi) in wanted[v].items()}) for v, n in totals.items()
    }


def _bracket(typed: DataFrame, columns: list[str], probs: list[float]) -> tuple[dict[str, int], dict[tuple[str, float], tuple[float, float]]]:
    """Values per column, and two values between which a rank should lie, from one sketch a column."""
    ends = [e for p in probs for e in (max(p - SKETCH_REACH, 0.0), min(p + SKETCH_REACH, 1.0))]
    points = F.array(*[F.lit(e) for e in ends])
    sketch = {v: F.kll_sketch_get_quantile_double(F.kll_sketch_agg_double(v, F.lit(SKETCH_SIZE)), points) for v in columns}
    row = typed.agg(
        *[F.count(v).alias(f"n_{v}") for v in columns],
        *[F.when(F.count(v) > 0, s).alias(f"at_{v}") for v, s in sketch.items()],
    ).first()
    totals = {v: row[f"n_{v}"] for v in columns}
    return totals, {(v, p): tuple(row[f"at_{v}"][2 * i : 2 * i + 2]) for v in columns if totals[v] for i, p in enumerate(probs)}


def _counted(
    typed: DataFrame, brackets: dict[tuple[str, float], tuple[float, float]]
) -> dict[tuple[str, float], tuple[float, float, int, int, int, int]]:
    """Brackets with the number of values below and up to their lower and their upper end."""
    if not brackets:
        return {}
    counts = [F.count_if(c) for (v, _), ends in brackets.items() for e in ends for c in (F.col(v) < e, F.col(v) <= e)]
    row = typed.agg(*[c.alias(f"c{i}") for i, c in enumerate(counts)]).first()
    return {key: (*ends, *row[4 * i : 4 * i + 4]) for i, (key, ends) in enumerate(brackets.items())}


def exact_quantiles(
    df: DataFrame, columns: Iterable[str], probs: Iterable[float], by: Iterable[str] = (), **options
) -> DataFrame:
    """Exact, linearly interpolated quantiles: rows ``(by..., column, prob, value)``.

    Missing values are ignored; a column without values yields no row.
    """
    points = quantile_points(df, columns, probs, by, **options)
    low, high, part = F.col("low"), F.col("high"), F.col("part")
    # The same rule as ``interpolate``: the result is the same from both sides.
    value = F.when(part >= 0.5, high - (high - low) * (1.0 - part)).otherwise(low + (high - low) * part)
    return points.select(*by, "column", "prob", value.alias("value"))


def quantiles_wide(
    df: DataFrame, columns: Iterable[str], names: dict[str, float], by: Iterable[str] = (), **options
) -> DataFrame:
    """One row per column, one named output column per probability."""
    by = list(by)
    long = exact_quantiles(df, columns, names.values(), by=by, **options)
    picks = [F.max(F.when(F.col("prob") == F.lit(p), F.col("value"))).alias(n) for n, p in names.items()]
    return long.groupBy(*by, "column").agg(*picks)


def medians_row(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Exact medians (mean of the middle two) as one row with one column per input column."""
    columns = list(columns)
    middle = order_statistics(df, columns, lambda total: _wanted_ranks(total, [0.5]))
    ends = [(F.min, F.max, F.when(F.col("column") == c, F.col("value")), c) for c in columns]
    return middle.agg(*[((lo(x) + hi(x)) / 2.0).alias(c) for lo, hi, x, c in ends])


def medians(df: DataFrame, columns: Iterable[str]) -> dict[str, float | None]:
    """The values of ``medians_row``, found at once."""
    columns = list(columns)
    points = {c: at[0.5] for c, (_, at) in found_points(df, columns, [0.5]).items()}
    return {c: (points[c][0] + points[c][1]) / 2.0 if c in points else None for c in columns}


def modes(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Most frequent value per column, smallest on ties: ``(column, top, freq)``.

    Counts are combined on the map side and spread by (column, value); only one
    best candidate per task is compared at the end.
    """
    counts = (
        melt(df, columns, as_type="string")
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    best = F.min_by("value", F.struct(-F.col("n"), F.col("value")))
    return counts.groupBy("column").agg(best.alias("top"), F.max("n").alias("freq"))


def modes_row(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    columns = list(columns)
    long = modes(df, columns)
    return long.agg(*[F.max(F.when(F.col("column") == c, F.col("top"))).alias(c) for c in columns])


def running_totals(
    df: DataFrame,
    order_col: str,
    measures: Iterable[str],
    descending: bool = False,
    coarse: int = 1024,
    fine: int = 64,
) -> DataFrame:
    """Add ``upto_<m>`` (total of ``m`` up to this key) and ``all_<m>`` (grand total).

    ``order_col`` is a unique numeric key (aggregate to it first) and ``df`` should
    read a written table, because it is visited a few times.  The key range is cut
    in ``coarse`` parts and each part in ``fine`` by its own extent; prefix sums run
    in parallel inside the parts, and only the per-part totals (at most
    coarse x fine rows) are accumulated together.
    """
    measures = list(measures)
    bounds = scalar_bounds(df, order_col)
    x = F.col(order_col).cast("double")
    keyed = df.withColumn("coarse_no", _fine_range(x, bounds["low"], bounds["high"], coarse))
    extents = keyed.groupBy("coarse_no").agg(F.min(x).alias("part_low"), F.max(x).alias("part_high"))
    keyed = keyed.join(F.broadcast(extents), "coarse_no")  # at most `coarse` rows
    keyed = keyed.withColumn("fine_no", _fine_range(x, F.col("part_low"), F.col("part_high"), fine))

    part = ["coarse_no", "fine_no"]

    def ordered(*names: str) -> list[Column]:
        return [F.col(n).desc() if descending else F.col(n).asc() for n in names]

    totals = keyed.groupBy(*part).agg(*[F.sum(m).alias(f"part_{m}") for m in measures])
    everything = Window.partitionBy()
    before = everything.orderBy(*ordered(*part)).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *part,
        *[F.coalesce(F.sum(f"part_{m}").over(before), F.lit(0)).alias(f"before_{m}") for m in measures],
        *[F.sum(f"part_{m}").over(everything).alias(f"all_{m}") for m in measures],
    )
    inside = (
        Window.partitionBy(*part)
        .orderBy(*ordered(order_col))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return keyed.join(F.broadcast(offsets), part).select(  # at most coarse x fine rows
        *[F.col(c) for c in df.columns],
        *[(F.col(f"before_{m}") + F.sum(m).over(inside)).alias(f"upto_{m}") for m in measures],
        *[F.col(f"all_{m}") for m in measures],
    )


def positions(df: DataFrame, order: Iterable[str], name: str) -> DataFrame:
    """Adds the 0-based position of every row in the sorted order, without a window over all rows.

    Rows are range-sorted and written with the number of their partition; each partition is numbered on its own and
    shifted by the rows of those before it (one offset per partition).
    """
    order = list(order)
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id())
    held = materialise(ranged, "positions")
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.groupBy("__part").count().select("__part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy("__part").orderBy(*order)) - 1
    return held.join(F.broadcast(offsets), "__part").withColumn(name, place + F.col("__before")).drop("__part", "__before")


def scalar_bounds(df: DataFrame, column: str) -> Column:
    """``{low, high}`` of a column as a scalar subquery."""
    x = F.col(column).cast("double")
    return df.agg(F.struct(F.min(x).alias("low"), F.max(x).alias("high")).alias("b")).scalar()
