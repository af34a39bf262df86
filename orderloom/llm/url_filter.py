"""URL verdicts: fixed rules where they fit, and elsewhere the trust and distrust that reach a host over the links between hosts.

The longest rule that fits a URL decides it.  Hosts with pages that the rules allow are seeds of trust, hosts with pages that they block seeds of
distrust, each weighing as many as it has such pages.  Trust follows links (a personalised PageRank), distrust goes against them: who links to blocked
hosts is suspect.  A host whose distrust outweighs its trust by more than ``THRESHOLD`` of its pages is blocked where no rule fits.

Scale: html is read once for its links, and only (host, host) pairs leave the tasks, made distinct before the shuffle.  A round is one join of the
edges with the masses on the host they come from and one partial sum by the host they go to: the side that may be hot is the edges', which AQE splits;
masses have one row a host.  Each round's masses are written, so a lost executor replays one round.  The driver receives a few sums a round.
The verdicts of hosts are a written table, which Spark broadcasts to the pages only if its true size allows.

Defined cases: a null url or one without ``://`` has an empty host and path, fits no rule and is allowed: nothing speaks against it; a host that nothing reaches is
allowed; null html has no links; links of a host to itself are no votes, and several between two hosts are one; hosts that are only linked to pass masses on
and have no pages to judge; a host without links on returns its mass to the seeds; without seeds all masses are zero; repeated pages count
as often as they occur; an empty table gives an empty result.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.session import materialise

ALLOW, BLOCK = "allow", "block"
#: Verdict, host, path.
RULES = ((BLOCK, "net", "/"), (ALLOW, "example.net", "/en/"), (BLOCK, "example.com", "/de/"), (ALLOW, "org", "/fr/"))
DAMPING = 0.85
#: Rounds end when the masses of all hosts together change by less than this share.
TOLERANCE = 1e-4
MOST_ROUNDS = 100
THRESHOLD = 0.25
#: Host of an absolute or protocol-relative link.
LINK = r"(?i)\bhref\s*=\s*[\"']?\s*(?:https?:)?//([^/?#\"'\s<>]+)"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

Rule = tuple[str, str, str]


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def host_and_path(url: Column) -> tuple[Column, Column]:
    """The part after the first ``://`` up to ``/``, ``?`` or ``#``, in lower case, and what follows up to ``?`` or ``#``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    return lower_ascii(host), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def fitting(host: Column, path: Column, rules: Iterable[Rule] = RULES) -> Column:
    """``struct<rule, verdict>`` of the longest rule that fits, or null."""
    found = []
    for verdict, domain, start in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        fits = ((host == domain) | host.endswith(f".{domain}")) & path.startswith(start)
        found.append(F.when(fits, F.struct(F.lit(domain + start).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*found) if found else F.lit(None).cast("struct<rule:string,verdict:string>")


def judged(pages: DataFrame, rules: Iterable[Rule] = RULES) -> DataFrame:
    """``(page_id, host, path, rule, ruled)`` of every page; no html."""
    host, path = host_and_path(F.col("url"))
    placed = pages.select("page_id", host.alias("host"), path.alias("path"))
    found = placed.withColumn("found", fitting(F.col("host"), F.col("path"), rules))
    return found.select("page_id", "host", "path", F.col("found.rule").alias("rule"), F.col("found.verdict").alias("ruled"))


def links(pages: DataFrame) -> DataFrame:
    """Distinct ``(src, dst)`` pairs of different hosts with a link from a page of the one to the other."""
    host, _ = host_and_path(F.col("url"))
    targets = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), F.lit(1)), lower_ascii))
    found = pages.select(host.alias("src"), F.explode(targets).alias("dst"))
    return found.filter((F.col("src") != "") & (F.col("src") != F.col("dst"))).distinct()


def seeds(judged_pages: DataFrame) -> DataFrame:
    """``(host, pages, allowed, blocked)``: how many pages of each host there are, and how many of them the rules allow or block."""
    count = lambda verdict: F.count_if(F.col("ruled") == verdict)
    known = judged_pages.filter(F.col("host") != "")
    return known.groupBy("host").agg(F.count("*").alias("pages"), count(ALLOW).alias("allowed"), count(BLOCK).alias("blocked"))


def propagate(
    hosts: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, most_rounds: int = MOST_ROUNDS
) -> DataFrame:
    """``(host, trust, distrust)`` of every host with pages or links.

    Trust sums to the allowed pages of ``hosts`` and distrust to the blocked ones.  In each round a host passes ``damping`` of
    its mass on in equal parts, trust to the hosts it links to and distrust to those that link to it; the rest, and all that hosts without such
    links hold, goes to the seeds by their weights.
    """
    kinds = {"trust": "allowed", "distrust": "blocked"}
    ways = [("trust", "src", "dst"), ("distrust", "dst", "src")]
    directed = reduce(
        DataFrame.unionByName, (edges.select(F.lit(k).alias("kind"), F.col(a).alias("host"), F.col(b).alias("to")) for k, a, b in ways)
    )
    out_links = directed.groupBy("kind", "host").agg(F.count("*").alias("fan"))
    directed = materialise(directed, "url_edges")
    nodes = directed.select("kind", "host").unionByName(directed.select("kind", F.col("to").alias("host")))
    sown = [hosts.select(F.lit(k).alias("kind"), "host", F.col(c).cast("double").alias("seed")) for k, c in kinds.items()]
    sown = reduce(DataFrame.unionByName, [*sown, nodes.distinct().withColumn("seed", F.lit(0.0))])
    state = sown.groupBy("kind", "host").agg(F.sum("seed").alias("seed")).join(out_links, ["kind", "host"], "left")
    state = materialise(state.withColumn("mass", F.col("seed")), "url_masses")
    for _ in range(most_rounds):
        idle = F.sum(F.when(F.col("fan").isNull(), F.col("mass")).otherwise(0.0))
        sums = {r["kind"]: r for r in state.groupBy("kind").agg(F.sum("seed").alias("seed"), idle.alias("idle")).collect()}
        if not sum(r["seed"] for r in sums.values()):
            break
        flow = state.filter(F.col("fan").isNotNull() & (F.col("mass") > 0)).select("kind", "host", (F.col("mass") / F.col("fan")).alias("part"))
        met = directed.join(flow, ["kind", "host"]).groupBy("kind", F.col("to").alias("host")).agg(F.sum("part").alias("met"))
        back = F.lit(0.0)
        for kind, r in sums.items():
            share = (1 - damping) + damping * r["idle"] / r["seed"] if r["seed"] else 0.0
            back = F.when(F.col("kind") == kind, F.lit(share)).otherwise(back)
        mass = F.col("seed") * back + damping * F.coalesce("met", F.lit(0.0))
        moved = state.join(met, ["kind", "host"], "left").select("kind", "host", "seed", "fan", F.col("mass").alias("was"), mass.alias("mass"))
        moved = materialise(moved, "url_masses")
        change = moved.agg(F.sum(F.abs(F.col("mass") - F.col("was")))).first()[0]
        state = moved.drop("was")
        if change <= tolerance * sum(r["seed"] for r in sums.values()):
            break
    mass = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("mass"))), F.lit(0.0)).alias(kind)
    return state.groupBy("host").agg(mass("trust"), mass("distrust"))


def host_verdicts(hosts: DataFrame, masses: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``(host, excess, verdict)``: distrust less trust a page, and what follows for pages without a rule."""
    # Rounded, so that the order of the sums does not decide ties with the threshold.
    excess = F.round((F.coalesce("distrust", F.lit(0.0)) - F.coalesce("trust", F.lit(0.0))) / F.col("pages"), 9)
    found = hosts.join(masses, "host", "left").select("host", excess.alias("excess"))
    return found.withColumn("spread", F.when(F.col("excess") > threshold, F.lit(BLOCK)).otherwise(F.lit(ALLOW)))


def verdicts(pages: DataFrame, rules: Iterable[Rule] = RULES, threshold: float = THRESHOLD) -> DataFrame:
    """``(page_id, host, path, rule, verdict, excess)`` of every page; ``excess`` is null for pages without a host."""
    rules = tuple(rules)
    found = judged(pages, rules)
    hosts = materialise(seeds(found), "url_hosts")
    edges = materialise(links(pages), "url_links")
    spread = materialise(host_verdicts(hosts, propagate(hosts, edges), threshold), "url_verdicts")
    verdict = F.coalesce("ruled", "spread", F.lit(ALLOW)).alias("verdict")
    return found.join(spread, "host", "left").select("page_id", "host", "path", "rule", verdict, "excess")
