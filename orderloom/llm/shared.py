"""Helpers the operators share: row keys, Arrow batch bounds, span arrays, prefix sums, numbered rows."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderloom.session import configure, materialise

#: Bytes of one Arrow batch handed to Python; the working set of a task is a small multiple of it.
BATCH_BYTES = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Arrow batches of its rows are bounded in bytes for the Python steps."""
    bounded_batches(configure(spark))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def row_key(doc_id: Column, text: Column) -> Column:
    """Identity of a row that also holds for null or repeated ids; equal rows share it."""
    part = lambda c: F.coalesce(F.concat(F.lit("="), c.cast("string")), F.lit("~"))
    return F.md5(F.concat(part(doc_id), F.lit("\n"), part(text)))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def prefix_sums(values: Column) -> Column:
    """Inclusive running sums of an array."""
    return _running(values, lambda s, x: s + x)


def prefix_max(values: Column) -> Column:
    """Inclusive running maximum of an array of numbers that are not negative."""
    return _running(values, lambda s, x: F.greatest(s, x))


def _running(values: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Inclusive running fold from zero, in blocks of the array's square root so that long arrays stay cheap."""
    zero = F.lit(0).cast("bigint")
    total = lambda a: F.aggregate(a, zero, join)

    def of(v: Column) -> Column:
        width = F.ceil(F.sqrt(F.size(v))).cast("int")
        blocks = F.transform(
            F.sequence(F.lit(0), F.ceil(F.size(v) / width).cast("int") - 1), lambda k: F.slice(v, k * width + 1, width)
        )
        return let(blocks, lambda b: let(F.transform(b, total), lambda sums: put(b, sums)))

    def put(b: Column, sums: Column) -> Column:
        within = lambda x, before: F.transform(x, lambda v, j: join(before, total(F.slice(x, 1, j + 1))))
        return F.flatten(F.transform(b, lambda x, k: let(total(F.slice(sums, 1, k)), lambda s: within(x, s))))

    empty = F.array().cast("array<bigint>")
    return F.when(F.size(values) == 0, empty).otherwise(let(values, of))


def spans(text: Column, pattern: str, *needs: str) -> Column:
    """``array<struct<start, end, match, before, after>>`` of the leftmost non-overlapping matches.

    Offsets are code points, end exclusive.  ``split`` gives the pieces between the matches,
    so offsets are running sums of lengths; ``before`` and ``after`` are the neighbouring pieces' ends.
    A match holds one of ``needs`` in some case: texts without any are passed over by a plain substring search.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))

    def build(m: Column) -> Column:
        return let(F.split(text, pattern, -1), lambda pieces: placed(m, pieces))

    def placed(m: Column, pieces: Column) -> Column:
        size = lambda x: F.char_length(x).cast("bigint")
        ends = prefix_sums(F.transform(m, lambda x, i: size(x) + size(F.get(pieces, i))))
        return let(
            ends,
            lambda e: F.transform(
                m,
                lambda x, i: F.struct(
                    (F.get(e, i) - size(x)).alias("start"),
                    F.get(e, i).alias("end"),
                    x.alias("match"),
                    F.right(F.get(pieces, i), F.lit(48)).alias("before"),
                    F.left(F.get(pieces, i + 1), F.lit(48)).alias("after"),
                ),
            ),
        )

    shape = "array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>"
    there = text.rlike(pattern)
    if needs:
        plain = text if all(n.upper() == n.lower() for n in needs) else F.lower(text)
        there = reduce(lambda a, b: a | b, (plain.contains(n.lower()) for n in needs)) & there
    return F.when(there, let(matches, build)).otherwise(F.array().cast(shape))


def numbered(df: DataFrame, order: list[Column], number: str, purpose: str) -> DataFrame:
    """``df`` (written once) with 0-based positions in the sorted order, without a window over all rows.

    Rows are range-sorted and written with their partition's number; each partition is numbered on its
    own and shifted by the rows of the partitions before it (one offset per partition).
    """
    parts = max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    held = materialise(
        df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()),
        purpose,
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = held.groupBy("_part").count().select("_part", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_part").orderBy(*order)).cast("bigint") - 1
    return held.join(F.broadcast(offsets), "_part").withColumn(number, place + F.col("_off")).drop("_part", "_off")
