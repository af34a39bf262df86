"""Merkle manifest of a dataset: a content-addressed tree per source, and inclusion proofs that descend it from the root.

Each row is a leaf.  Leaves of a source ascend by id; runs of ``FANOUT`` neighbours become one node until a single one, the
subroot, is left, and the subroots form a tree of their own.  Every node is stored as a record digest -> children.  A proof starts at
the root: each record met is opened at the digit of the wanted rank, the children that were not taken are collected, and the way
is reversed at the end.  Folding a leaf with its collected siblings must give the root again.

Scale: texts are read and hashed once; what follows handles digests only.  Ranks come from a range sort, so a source that owns a third of all
rows is spread over many tasks.  A level is one grouping of at most ``FANOUT`` rows a group, and has a sixteenth of the rows of the one below.
Requests below one node share its way: the frontier of the descent has one row per opened node, not one per leaf, so ways (about one kB a
level) travel once per run of leaves and are spelt out per leaf only where they are folded.  Ways and records are joined by sorting: Spark takes
a frontier for far smaller than it is, and a broadcast one would go through the driver.  The driver receives counts and the root.

Defined cases: a null field counts as ``-``; a null source is a source of its own, before all others; null ids come first in their source;
rows that share an id are ordered by their leaf digest, equal rows are equal leaves, each with a rank of its own; a lone leaf is its subroot, a
lone subroot the root; an empty table has neither root nor proofs.  Other columns are not looked at, and their names do not clash.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import let, numbered
from orderloom.session import materialise

FANOUT = 16
DIGIT_BITS = 4
TAMPERED = 5
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
WAY = "array<struct<left:string,right:string>>"


def leaf_digest(fields: list[Column]) -> Column:
    """Digest of a row: each field as its length in bytes, a colon and its value."""

    def part(c: Column) -> Column:
        value = c.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[part(c) for c in fields]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``(source, doc_id, leaf, altered)``: ``altered`` is the leaf of the tampered row, null for rows that are not tampered with."""
    whole = [F.col(c) for c in FIELDS]
    lowered = [F.translate("text", UPPER, UPPER.lower()) if c == "text" else F.col(c) for c in FIELDS]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return docs.select("source", "doc_id", leaf_digest(whole).alias("leaf"), F.when(chosen, leaf_digest(lowered)).alias("altered"))


@dataclass
class Manifest:
    """A committed dataset.

    ``members``: (tree, rank, n, doc_id, leaf, altered), a row per leaf; ``levels`` and ``top_levels``: records (tree, idx, digest, n,
    children) of each level above the leaves, of the sources and of the tree of subroots; ``subroots``: (tree, digest, level).
    """

    members: DataFrame
    levels: list[DataFrame]
    subroots: DataFrame
    top_levels: list[DataFrame]
    root: str | None


def _build(nodes: DataFrame, most: int, purpose: str) -> list[DataFrame]:
    """Records of every level above ``nodes`` (tree, idx, digest, n: nodes of its tree on this level); trees of one node are finished."""
    levels = []
    while most > 1:
        open_trees = nodes.filter(F.col("n") > 1)
        runs = open_trees.groupBy("tree", "n", F.shiftright("idx", DIGIT_BITS).alias("run")).agg(
            F.array_sort(F.collect_list(F.struct("idx", "digest")))["digest"].alias("children")  # at most FANOUT rows
        )
        level = runs.select(
            "tree", F.col("run").alias("idx"), F.sha2(F.concat_ws("", "children"), 256).alias("digest"),
            F.ceil(F.col("n") / FANOUT).cast("bigint").alias("n"), "children",
        )
        nodes = materialise(level, purpose)
        levels.append(nodes)
        most = -(-most // FANOUT)
    return levels


def commit(docs: DataFrame) -> Manifest:
    """Hash the rows, rank them in their sources and store the records of all levels."""
    hashed = materialise(leaves(docs), "merkle_leaves")
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    placed = materialise(numbered(hashed, order, "pos", "merkle_sorted"), "merkle_placed")
    starts = placed.groupBy("source").agg(F.min("pos").alias("start"), F.count("*").alias("n"))
    # One row per source, written: Spark broadcasts it only if its true size allows.
    sources = materialise(numbered(starts, [F.col("start")], "tree", "merkle_starts"), "merkle_sources")
    of = sources.select(F.col("source").alias("of_source"), "start", "n", "tree")
    members = placed.join(of, F.col("source").eqNullSafe(F.col("of_source"))).select(
        "tree", (F.col("pos") - F.col("start")).alias("rank"), "n", "doc_id", "leaf", "altered"
    )
    most, trees = sources.agg(F.coalesce(F.max("n"), F.lit(0)), F.count("*")).first()
    nodes = members.select("tree", F.col("rank").alias("idx"), F.col("leaf").alias("digest"), "n")
    levels = _build(nodes, most, "merkle_level")
    tops = nodes.filter(F.col("n") == 1).select("tree", "digest", F.lit(0).alias("level"))
    for number, level in enumerate(levels, 1):
        tops = tops.unionByName(level.filter(F.col("n") == 1).select("tree", "digest", F.lit(number).alias("level")))
    subroots = materialise(tops, "merkle_subroots")
    top_nodes = subroots.select(F.lit(0).cast("bigint").alias("tree"), F.col("tree").alias("idx"), "digest", F.lit(trees).cast("bigint").alias("n"))
    top_levels = _build(top_nodes, trees, "merkle_top")
    last = top_levels[-1] if top_levels else subroots
    row = last.select("digest").first()
    return Manifest(members, levels, subroots, top_levels, row and row["digest"])


def _siblings(children: Column, digit: Column) -> Column:
    """The children left and right of the one taken, as texts."""
    left = F.slice(children, F.lit(1), digit)
    right = F.slice(children, digit + 2, F.lit(FANOUT))
    return F.struct(F.concat_ws("", left).alias("left"), F.concat_ws("", right).alias("right"))


def _sorted_join(ways: DataFrame, other: DataFrame, on: str | list[str]) -> DataFrame:
    """Inner join of rows that carry their ways, neither side of which is broadcast whatever its estimated size."""
    return ways.hint("merge").join(other.hint("merge"), on)


def _open(frontier: DataFrame, level: DataFrame) -> DataFrame:
    """The frontier's nodes with their children; records are looked up by digest, equal ones are one record."""
    records = level.select("digest", "children").dropDuplicates(["digest"])
    return _sorted_join(frontier, records, "digest")


def _descend(opened: DataFrame, *keep: str) -> DataFrame:
    """One row per child: its place in the level below, its digest and its way."""
    digit = F.col("digit")
    return opened.select("*", F.posexplode("children").alias("digit", "child")).select(
        *keep,
        (F.shiftleft("idx", DIGIT_BITS) + digit).alias("idx"),
        F.col("child").alias("digest"),
        F.concat("way", F.array(_siblings(F.col("children"), digit))).alias("way"),
    )


def open_runs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """``(tree, idx, subroot, children, way)`` of every lowest record on the way to a requested leaf ``(tree, rank)``, or to any leaf.

    ``way`` leads from the root down to the record; a lone leaf has no record of its own and null ``children``.
    """
    spark = manifest.members.sparkSession
    frontier = spark.createDataFrame([(0, manifest.root)], "idx bigint, digest string").withColumn("way", F.array().cast(WAY))
    for level in reversed(manifest.top_levels):
        frontier = _descend(_open(frontier, level))
    depths = manifest.subroots.select(F.col("tree").alias("idx"), "level")
    entered = _sorted_join(frontier, depths, "idx").select(
        F.col("idx").alias("tree"), F.lit(0).cast("bigint").alias("idx"), "digest", F.col("digest").alias("subroot"), "way", "level"
    )
    entered = materialise(entered, "merkle_entered")

    def wanted(nodes: DataFrame, level: int) -> DataFrame:
        if requests is None:
            return nodes
        on_way = requests.select("tree", F.shiftright("rank", DIGIT_BITS * level).alias("idx")).distinct()
        return nodes.join(on_way, ["tree", "idx"], "left_semi")

    keep = ["tree", "idx", "subroot", "way"]
    lone = wanted(entered.filter("level = 0"), 0).select(*keep, F.lit(None).cast("array<string>").alias("children"))
    frontier = None
    for number in range(len(manifest.levels), 0, -1):
        here = wanted(entered.filter(F.col("level") == number), number).select("digest", *keep)
        frontier = here if frontier is None else here.unionByName(frontier)
        opened = _open(frontier, manifest.levels[number - 1])
        if number == 1:
            return opened.select(*keep, "children").unionByName(lone)
        frontier = wanted(_descend(opened, "tree", "subroot"), number - 1)
    return lone


def fold(start: Column, way: Column) -> Column:
    """The digest that a leaf and the siblings on its way, leaf first, lead to."""
    return F.aggregate(way, start, lambda node, s: F.sha2(F.concat(s["left"], node, s["right"]), 256))


def proofs(manifest: Manifest, requests: DataFrame | None = None) -> DataFrame:
    """Per requested leaf (a selection of ``manifest.members``; all of them by default) its way up and both of its digests.

    ``(tree, rank, doc_id, leaf, altered, subroot, way)``, where ``way`` holds the siblings from the leaf to the root.
    """
    asked = manifest.members if requests is None else requests
    # A run's requests travel together, at most FANOUT of them (and one row per request of an equal rank).
    runs = asked.groupBy("tree", F.shiftright("rank", DIGIT_BITS).alias("idx")).agg(
        F.collect_list(F.struct("rank", "doc_id", "leaf", "altered")).alias("asked")
    )
    met = _sorted_join(open_runs(manifest, requests), runs, ["tree", "idx"]).select("*", F.explode("asked").alias("one"))
    digit = F.col("one.rank").bitwiseAND(FANOUT - 1).cast("int")
    own = F.when(F.col("children").isNotNull(), F.array(_siblings(F.col("children"), digit))).otherwise(F.array().cast(WAY))
    return met.select("tree", "one.*", "subroot", F.concat(own, F.reverse("way")).alias("way"))


def verify(docs: DataFrame) -> DataFrame:
    """Per row its leaf, subroot and root, the digest of its proof, and the root that the (maybe tampered) row folds to."""
    manifest = commit(docs)
    if manifest.root is None:
        names = ["doc_id bigint", *(f"{c} string" for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), "verified boolean"]
        return docs.sparkSession.createDataFrame([], ", ".join(names))
    root = F.lit(manifest.root)
    text = lambda way: F.concat_ws("", F.flatten(F.transform(way, lambda s: F.array(s["left"], s["right"]))))
    met = proofs(manifest).select(
        "doc_id", "leaf", "subroot",
        let(F.struct("way", F.coalesce("altered", "leaf").alias("start")), lambda x: F.struct(
            F.sha2(text(x["way"]), 256).alias("proof_sha256"), fold(x["start"], x["way"]).alias("folded_root")
        )).alias("found"),
    )
    return met.select("doc_id", "leaf", "subroot", root.alias("root"), "found.*").withColumn("verified", F.col("folded_root") == root)
