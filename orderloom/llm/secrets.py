"""Secret scan [native]: base patterns plus multipart credential linking by an interval join.

Strong parts (assignments, access identifiers, long hex runs) are reported as they are.  Weak parts
(40-character secrets, identifiers of 16 and more capitals and digits, endpoints) are reported only when
parts that complement them lie in the same scope: a secret needs an identifier, an identifier needs a
secret, an endpoint needs both.  A scope is ``SCOPE`` code points of one text.

The join is on (row, bin of SCOPE code points) after each bin is reduced to its first and last part of each
role, so a text with very many parts yields rows in proportion to its parts, never pairs.  No Python runs
on the executors and text is never shuffled.

Defined cases: null text counts as empty; null or repeated ids keep one result row per input row; equal
rows have equal results; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import let, prefix_max, row_key, spans
from orderloom.session import materialise

#: Code points within which complementary parts must lie.
SCOPE = 512

# Base patterns and the least length of what they must hold.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}+"
HEX = r"[0-9a-f]{24,}+"
BASE = ("assign", "access", "hex")
LEAST_VALUE = 6

WEAK_SECRET = r"(?<![A-Za-z0-9/+=_-])[A-Za-z0-9/+]{40}(?![A-Za-z0-9/+=_-])"
WEAK_IDENTIFIER = r"(?<![A-Za-z0-9])[A-Z0-9]{16,40}(?![A-Za-z0-9])"
ENDPOINT = r"(?:https?|jdbc:[a-z]+|s3|postgres(?:ql)?|mongodb|redis)://[A-Za-z0-9._:@/-]+"
KINDS = (*BASE, "weak_secret", "weak_identifier", "endpoint")


def _narrow(docs: DataFrame) -> DataFrame:
    """Per row: key and all parts as ``array<struct<start, end, kind>>``, written once without the text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    mixed = lambda m: m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")
    found = {
        "assign": F.filter(
            spans(text, ASSIGN, "password", "passwd", "secret", "token", "apikey", "api_key"), lambda s: F.length(F.regexp_extract(s["match"], ASSIGN, 2)) >= LEAST_VALUE
        ),
        "access": spans(text, ACCESS, "AKIA"),
        "hex": spans(text, HEX),
        "weak_secret": F.filter(spans(text, WEAK_SECRET), lambda s: mixed(s["match"])),
        "weak_identifier": F.filter(
            spans(text, WEAK_IDENTIFIER), lambda s: s["match"].rlike("[A-Z]") & s["match"].rlike("[0-9]")
        ),
        "endpoint": spans(text, ENDPOINT, "://"),
    }
    place = lambda k: lambda s: F.struct(s["start"], s["end"], F.lit(k).alias("kind"))
    parts = F.concat(*(F.transform(found[name], place(k)) for k, name in enumerate(KINDS)))
    return materialise(
        docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), parts.alias("parts")), "secret-parts"
    )


#: Which roles a kind plays for the others.
ROLES = {"identifier": (1, 4), "secret": (0, 2, 3)}
NEEDS = {3: ("identifier",), 4: ("secret",), 5: ("identifier", "secret")}


def linked(narrow: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``(key, extra)``: the weak parts of each key that have all their complements within the scope."""
    weak = lambda p: p["kind"] >= len(BASE)
    rows = (
        narrow.filter(F.exists("parts", weak) & (F.size("parts") > 1))
        .dropDuplicates(["key"])
        .select("key", F.explode("parts").alias("p"))
        .select("key", "p.*", F.floor(F.col("p.start") / scope).alias("bin"))
    )
    near = rows.filter(F.col("kind") >= len(BASE))
    for role, kinds in ROLES.items():
        bins = (
            rows.filter(F.col("kind").isin(*kinds))
            .groupBy("key", "bin")
            .agg(F.min("start").alias("low"), F.max("start").alias("high"), F.count("*").alias("n"))
        )
        # A part sees its own bin and both neighbours; within a bin any two parts lie in the scope.
        seen = bins.select(
            "key",
            F.explode(F.array([F.struct((F.col("bin") + d).alias("bin"), F.lit(-d).alias("side")) for d in (-1, 0, 1)])).alias("b"),
            "low", "high", "n",
        ).groupBy("key", F.col("b.bin").alias("bin")).agg(
            F.max(F.when(F.col("b.side") == 0, F.col("n"))).alias(f"{role}_here"),
            F.max(F.when(F.col("b.side") == 1, F.col("low"))).alias(f"{role}_next"),
            F.max(F.when(F.col("b.side") == -1, F.col("high"))).alias(f"{role}_last"),
        )
        near = near.join(seen, ["key", "bin"], "left")

    def has(role: str, kinds: tuple[int, ...]) -> Column:
        own = F.when(F.col("kind").isin(*kinds), 1).otherwise(0)
        gap = lambda c: F.abs(F.col(c) - F.col("start")) <= scope
        return F.coalesce(
            (F.coalesce(F.col(f"{role}_here"), F.lit(0)) > own)
            | F.coalesce(gap(f"{role}_next"), F.lit(False))
            | F.coalesce(gap(f"{role}_last"), F.lit(False)),
            F.lit(False),
        )

    wanted = lambda roles: reduce(lambda a, b: a & b, (has(r, ROLES[r]) for r in roles))
    keep = reduce(lambda a, b: a | b, ((F.col("kind") == k) & wanted(roles) for k, roles in NEEDS.items()))
    return near.filter(keep).groupBy("key").agg(F.collect_list(F.struct("start", "end", "kind")).alias("extra"))


def _uncovered(weak: Column, base: Column) -> Column:
    """The weak parts that no base part covers whole: in the order of starts, base parts first, none has reached their end yet."""
    event = lambda rank: lambda p: F.struct(p["start"].alias("start"), F.lit(rank).alias("weak"), p["end"].alias("end"), p["kind"].alias("kind"))
    events = F.array_sort(F.concat(F.transform(base, event(0)), F.transform(weak, event(1))))
    reached = lambda e: prefix_max(F.transform(e, lambda p: F.when(p["weak"] == 0, p["end"]).otherwise(F.lit(0).cast("bigint"))))
    plain = lambda p: F.struct(p["start"].alias("start"), p["end"].alias("end"), p["kind"].alias("kind"))
    free = lambda e, r: F.filter(e, lambda p, i: (p["weak"] == 1) & (F.get(r, i) < p["end"]))
    return let(events, lambda e: let(reached(e), lambda r: F.transform(free(e, r), plain)))


def scan(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """``(doc_id, key, base, found)`` per row: base parts and all reported parts, by start, then kind."""
    narrow = _narrow(docs)
    ordered = lambda a: F.array_sort(
        F.transform(a, lambda p: F.struct(p["start"].alias("start"), p["kind"].alias("kind"), p["end"].alias("end")))
    )
    base = F.filter("parts", lambda p: p["kind"] < len(BASE))
    none = F.array().cast("array<struct<start:bigint,end:bigint,kind:int>>")
    extra = F.when(F.coalesce(F.size("extra"), F.lit(0)) > 0, _uncovered(F.col("extra"), base)).otherwise(none)
    return narrow.join(linked(narrow, scope), "key", "left").select(
        "doc_id", "key", ordered(base).alias("base"), ordered(F.concat(base, extra)).alias("found")
    )


def listing(parts: Column) -> Column:
    """``kind:start:end`` comma-joined."""
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(
        F.transform(parts, lambda p: F.concat_ws(":", F.get(name, p["kind"]), p["start"], p["end"])), ","
    )


def redact(docs: DataFrame, scope: int = SCOPE, mark: str = "[SECRET]") -> DataFrame:
    """The documents with every reported part replaced by ``mark``; columns and rows stay, ``n_chars`` follows.

    Overlapping parts are replaced once: a piece is kept from the end of what came before it.
    """
    found = scan(docs, scope).filter(F.size("found") > 0).select("key", "found").dropDuplicates(["key"])
    found = found.withColumnsRenamed({"key": "__key", "found": "__found"})
    text, parts = docs["text"], F.col("__found")
    # Four bytes a code point, so a piece is cut at its place without reading what is before it.
    held = F.struct(F.encode(text, "UTF-32").alias("wide"), prefix_max(F.transform(parts, lambda p: p["end"])).alias("reach"))
    piece = lambda x, start, end: F.decode(F.substring(x["wide"], (start * 4 + 1).cast("int"), ((end - start) * 4).cast("int")), "UTF-32")
    before = lambda x, i: F.coalesce(F.get(x["reach"], i - 1), F.lit(0))

    def cut(x: Column) -> Column:
        kept = F.transform(
            parts,
            lambda p, i: F.when(p["start"] >= before(x, i), F.concat(piece(x, before(x, i), p["start"]), F.lit(mark))).otherwise(F.lit("")),
        )
        return F.concat(F.concat_ws("", kept), piece(x, before(x, F.size(parts)), F.length(text)))

    clean = F.when(parts.isNull(), text).otherwise(let(held, cut))
    columns = [clean.alias(c) if c == "text" else docs[c] for c in docs.columns]
    out = docs.join(found, row_key(docs["doc_id"], text) == found["__key"], "left").select(*columns)
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out


def digest(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """Per row: counts of the base kinds, the digest of the base parts, and all parts as text."""
    found = scan(docs, scope)
    count = lambda k: F.size(F.filter("base", lambda p: p["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{name}") for k, name in enumerate(BASE)),
        F.sha2(listing(F.col("base")), 256).alias("base_sha256"),
        listing(F.col("found")).alias("spans"),
    )
