"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderloom.session import materialise


def components(edges: DataFrame, purpose: str) -> DataFrame:
    """``(node, component)`` of every node with an edge ``(a, b)``; a component is named by its smallest node.

    Each round links every node to the smallest node it knows (large star, then small star), so the rounds grow with the
    logarithm of the longest path.  Minima are partial aggregates and the joins on them may be split, so a hub
    with very many edges is no single task.  Rounds are cut by written tables in the shared folder.
    """
    flat = edges.filter(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    stars, before = materialise(flat.distinct(), purpose), None
    while True:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.*").filter(F.col("u") != F.col("v")).distinct()
        )
        stars = materialise(small, purpose)
        now = stars.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    roots = stars.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return stars.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
