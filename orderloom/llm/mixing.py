"""Mixing sources to target weights by a low-discrepancy slot schedule.

1. Sources in code point order (null last) weigh 5, 2, 1, repeating; together they take ``share`` of all words.
   A target above ``most`` times its source is cut there and the excess reshared by weight (water filling; each
   round is one aggregation over the source table, one row per source).
2. Slots 0, 1, 2 ... get van der Corput points, which fall into the sources' cumulative targets; a source's slots
   are ranked.
3. Each source's documents are shuffled by a seeded hash and laid end to end, pass after pass, and cut into as many
   equal-token blocks as the source has slots; block k goes to the source's k-th slot.

A source may own most rows: running sums are taken per (source, hash bucket) and shifted by bucket totals, slot ranks
per (source, run of slots), so no task gets a whole source.  Only (id, source, size) is ever shuffled, no text.

Defined cases: null text has size 0 and takes 0; null sources form one source; equal rows are separate documents; the
result has one row per input row; reruns agree.  An empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.shared import numbered, row_key
from orderloom.session import materialise

# Weights by source order, share of all words, most passes over a source.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
WORD = r"[^\x20\x09-\x0D]+"

BLOCK_WORDS = 1024
SEED = 17
#: Rows of one window: documents of a hash bucket, slots of a run.
BUCKET_ROWS = 50_000


def targets(sizes: DataFrame, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``(source, source_no, source_size, target, take)`` of every source."""
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = numbered(by_source, [F.col("source").asc_nulls_last()], "source_no", "mix-sources")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in WEIGHTS)), (F.col("source_no") % len(WEIGHTS) + 1).cast("int"))
    ranked = ranked.select("*", weight.alias("weight"), (F.lit(float(most)) * F.col("source_size")).alias("cap"))
    total = ranked.agg(F.coalesce(F.sum("source_size"), F.lit(0)).alias("n")).first()["n"] * share
    level = 0.0
    while True:  # the level only rises, so a source once cut stays cut
        cut = F.col("weight") * F.lit(level) > F.col("cap")
        row = ranked.agg(
            F.sum(F.when(cut, F.col("cap"))).alias("held"), F.sum(F.when(~cut, F.col("weight"))).alias("free")
        ).first()
        raised = (total - (row["held"] or 0.0)) / row["free"] if row["free"] else level
        if raised <= level:
            break
        level = raised
    target = F.least(F.col("weight") * F.lit(level), F.col("cap"))
    return ranked.select("source", "source_no", "source_size", target.alias("target"), F.floor(target).alias("take"))


def _running(df: DataFrame, group: str, bucket: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Exclusive running sums of ``value`` per group, bucket after bucket."""
    earlier = lambda w: w.rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(group, bucket).agg(F.sum(value).alias("_sum"))
    offsets = totals.select(
        group, bucket, F.coalesce(F.sum("_sum").over(earlier(Window.partitionBy(group).orderBy(bucket))), F.lit(0)).alias("_before")
    )
    inside = F.coalesce(F.sum(value).over(earlier(Window.partitionBy(group, bucket).orderBy(*order))), F.lit(0))
    return df.withColumn(name, inside).join(offsets, [group, bucket]).withColumn(name, F.col(name) + F.col("_before")).drop("_before")


def slots(sources: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``(slot, source_no, block, blocks)``: the schedule, and how many blocks the slot's source has."""
    spark = sources.sparkSession
    size = sources.agg(
        F.coalesce(F.sum("take"), F.lit(0)).alias("words"), F.count("*").alias("sources")
    ).first()
    count = -(-size["words"] // block_words)
    order = Window.orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    # One row per source; cumulative in runs of source numbers so that no window sees more than a run.
    runs = sources.filter(F.col("take") > 0).withColumn("run", F.floor(F.col("source_no") / BUCKET_ROWS))
    base = runs.groupBy("run").agg(F.sum("take").alias("s"), F.min("source_no").alias("source_no"))
    base = base.select("run", F.coalesce(F.sum("s").over(order), F.lit(0)).alias("base"))
    inside = Window.partitionBy("run").orderBy("source_no").rowsBetween(Window.unboundedPreceding, -1)
    lines = runs.join(F.broadcast(base), "run").select(
        "source_no", "take", (F.coalesce(F.sum("take").over(inside), F.lit(0)) + F.col("base")).alias("low")
    )
    width = max(1, size["words"] // max(64, 4 * size["sources"]))
    lines = lines.select(
        "source_no", "low", (F.col("low") + F.col("take")).alias("high"),
        F.explode(F.sequence(F.floor(F.col("low") / width), F.floor((F.col("low") + F.col("take") - 1) / width))).alias("bin"),
    )
    bits = F.bin("slot")
    point = F.conv(F.reverse(bits), 2, 10).cast("double") / F.pow(F.lit(2.0), F.length(bits))
    at = F.least(F.floor(point * F.lit(float(size["words"]))), F.lit(max(0, size["words"] - 1)))
    drawn = spark.range(count).withColumnRenamed("id", "slot").select("slot", at.alias("at"))
    drawn = drawn.withColumn("bin", F.floor(F.col("at") / width))
    hit = drawn.join(lines, "bin").filter((F.col("at") >= F.col("low")) & (F.col("at") < F.col("high")))
    hit = hit.select("slot", "source_no")
    # Every source with words to give has a slot of its own, after the drawn ones if no point fell on it.
    missed = sources.filter(F.col("take") > 0).join(hit.select("source_no").distinct(), "source_no", "left_anti")
    all_slots = hit.unionByName(missed.select((F.col("source_no") + F.lit(count)).alias("slot"), "source_no"))
    all_slots = materialise(all_slots.withColumn("run", F.floor(F.col("slot") / BUCKET_ROWS)), "mix-slots")
    ranked = _running(all_slots, "source_no", "run", ["slot"], F.lit(1), "block").drop("run")
    per = all_slots.groupBy("source_no").agg(F.count("*").alias("drawn"))
    blocks = per.join(sources.select("source_no", "take"), "source_no").select(
        "source_no", F.least("drawn", "take").alias("blocks")
    )
    return ranked.join(blocks, "source_no").filter(F.col("block") < F.col("blocks"))


def schedule(docs: DataFrame, share: float = SHARE, most: float = MOST, block_words: int = BLOCK_WORDS) -> DataFrame:
    """One row per (document, slot) piece, and one for each document without any.

    Columns: doc_id, source, source_no, size, source_size, target, at (place of the document in its source's line),
    slot, block, pass, from_word, words.
    """
    rows = docs.select("doc_id", "source", F.regexp_count(F.coalesce("text", F.lit("")), F.lit(WORD)).cast("bigint").alias("size"))
    rows = materialise(rows, "mix-sizes")
    sources = materialise(targets(rows, share, most), "mix-targets")
    buckets = -(-rows.count() // BUCKET_ROWS) or 1
    shuffled = F.xxhash64("doc_id", F.lit(SEED))
    own = rows.join(sources, rows["source"].eqNullSafe(sources["source"])).select(
        "doc_id", rows["source"], "source_no", "size", "source_size", "target", "take",
        shuffled.alias("order"), F.pmod(shuffled, F.lit(buckets)).alias("bucket"),
    )
    line = _running(own, "source_no", "bucket", ["order", "doc_id", "size"], F.col("size"), "at")
    plan = slots(sources, block_words)
    blocks = plan.groupBy("source_no").agg(F.max("blocks").alias("blocks"))
    line = materialise(line.join(blocks, "source_no", "left"), "mix-line")
    given = (F.col("size") > 0) & (F.col("at") < F.col("take")) & F.col("blocks").isNotNull()
    # The infinite line of passes, up to what the source gives.
    passes = F.sequence(F.lit(0), F.lit(int(most) - 1))
    start = F.col("pass") * F.col("source_size") + F.col("at")
    pieces = line.filter(given).select("*", F.explode(passes).alias("pass")).select(
        "*", start.alias("low"), F.least(start + F.col("size"), F.col("take")).alias("high")
    )
    pieces = pieces.filter(F.col("low") < F.col("high"))
    # The first `longer` blocks of a source have one word more than the others.
    width, longer = F.floor(F.col("take") / F.col("blocks")), F.col("take") % F.col("blocks")
    edge = lambda k: k * width + F.least(k, longer)
    block_of = lambda x: F.when(x < longer * (width + 1), F.floor(x / (width + 1))).otherwise(
        longer + F.floor((x - longer * (width + 1)) / width)
    )
    pieces = pieces.select(
        "*", F.explode(F.sequence(block_of(F.col("low")), block_of(F.col("high") - 1))).alias("block")
    )
    low, high = F.greatest("low", edge(F.col("block"))), F.least("high", edge(F.col("block") + 1))
    document = ["doc_id", "source", "source_no", "size", "source_size", "target", "at"]
    pieces = pieces.select(*document, "pass", "block", (low - start).alias("from_word"), (high - low).alias("words"))
    taken = pieces.join(plan.select("source_no", "block", "slot"), ["source_no", "block"])
    return taken.unionByName(line.filter(~F.coalesce(given, F.lit(False))).select(document), allowMissingColumns=True)


def digest(docs: DataFrame, **how) -> DataFrame:
    """Per document: size, its source's size and target, and the words the schedule takes from it."""
    pieces = schedule(docs, **how)
    sized, empty = pieces.filter(F.col("slot").isNotNull()), pieces.filter(F.col("slot").isNull())
    columns = ["doc_id", "size", "source_size", "target", "taken"]
    taken = F.coalesce(F.sum("words"), F.lit(0)).cast("bigint").alias("taken")
    # ``at`` tells documents with words apart, also equal ones; those without a slot have one row each.
    summed = sized.groupBy("doc_id", "source_no", "at", "size", "source_size", "target").agg(taken)
    return summed.select(columns).unionByName(empty.withColumn("taken", F.lit(0).cast("bigint")).select(columns))


def take(docs: DataFrame, **how) -> DataFrame:
    """The documents that the mix takes from, with size, source_size, target and taken; equal rows show their mean."""
    keyed = docs.select(row_key(F.col("doc_id"), F.col("text")).alias("doc_id"), "source", "text")
    found = digest(keyed, **how).groupBy("doc_id").agg(
        F.first("size").alias("size"), F.first("source_size").alias("source_size"), F.first("target").alias("target"),
        F.floor(F.sum("taken") / F.count("*")).alias("taken"),
    )
    found = found.filter(F.col("taken") > 0).withColumnRenamed("doc_id", "__key")
    new = ["size", "source_size", "target", "taken"]
    return docs.drop(*new).join(found, row_key(docs["doc_id"], docs["text"]) == F.col("__key")).drop("__key")
