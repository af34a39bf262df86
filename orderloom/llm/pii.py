"""Personal data [native] by weak supervision: labelers vote, EM weighs them, a classifier decides on spans.

Candidates are the base kinds (email, ip, card, phone), which are always reported, and added kinds (ssn, account,
obfuscated email, titled name), which are reported if the classifier says so.  Each candidate gets one vote of
each labeler: a strict pattern, a gazetteer and the words around it (1 for, -1 against, 0 abstains).

Rows are reduced to (kind, votes) counts before anything leaves the tasks: at most kinds * 3 ** labelers rows, over all
documents.  EM over these counts estimates each labeler's reliability per kind; its posteriors are the soft labels of a
logistic span classifier (``pyspark.ml``, weighted by the counts).  The classifier's coefficients are applied as column
expressions.  No Python runs on the executors; text is neither shuffled nor written.

Defined cases: null text counts as empty; the result has one row per input row, whatever its id; an empty table gives an
empty result; other columns are not looked at.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderloom.llm.shared import spans
from orderloom.session import materialise

# Base patterns with the bounds of what counts.  Repetitions are possessive and a match starts where a
# run starts or the last match ended, which finds the same spans as the plain patterns in linear time.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
OCTET = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
BASE = ("email", "ip", "card", "phone")

SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"
ACCOUNT = r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}(?:\x20?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
HIDDEN_EMAIL = r"[A-Za-z0-9._%+-]{1,64}\x20?[\[(](?i:at)[\])]\x20?[A-Za-z0-9-]{1,63}(?:\x20?(?:\.|[\[(](?i:dot)[\])])\x20?[A-Za-z0-9-]{1,63}){1,8}"
NAME = r"(?<![A-Za-z])(?:Mr|Mrs|Ms|Dr|Prof)\.?\x20[A-Z][a-z]{1,30}(?:\x20[A-Z][a-z]{1,30}){0,2}"
KINDS = (*BASE, "ssn", "account", "hidden_email", "name")

# Gazetteers and context words of the labelers.
TOP_DOMAINS = "com org net edu gov io info biz de fr es it uk us ca nl pl ch at be eu".split()
COUNTRY_CODES = "1 7 20 27 30 31 32 33 34 39 40 41 43 44 45 46 47 48 49 52 55 61 81 82 86 90 91".split()
TITLES = "Mr Mrs Ms Dr Prof".split()
ACCOUNT_COUNTRIES = "AT BE CH DE DK ES FI FR GB IE IT LU NL NO PL PT SE".split()
FOR = {
    "email": "email e-mail mail contact write address",
    "ip": "ip host server address login client",
    "card": "card credit visa mastercard payment amex",
    "phone": "phone tel call mobile fax contact",
    "ssn": "ssn social security number",
    "account": "iban account bank transfer",
    "hidden_email": "email e-mail mail contact write address",
    "name": "name patient customer dear signed contact",
}
AGAINST = "version isbn release chapter section order invoice example figure part".split()

LABELERS = ("pattern", "gazetteer", "context")
ROUNDS = 30
#: Pseudo-counts of the reliabilities: a labeler starts as right in 7 of 10 votes.
PRIOR = (7.0, 3.0)


def _found(text: Column) -> dict[str, Column]:
    digits = lambda s: F.regexp_replace(s["match"], "[^0-9]", "")
    octets = "^" + r"\.".join([OCTET] * 4) + "$"
    return {
        "email": spans(text, EMAIL, "@"),
        "ip": F.filter(spans(text, IP), lambda s: s["match"].rlike(octets)),
        "card": F.filter(spans(text, CARD), lambda s: F.length(digits(s)).between(16, 19) & F.call_function("luhn_check", digits(s))),
        "phone": F.filter(spans(text, PHONE, "+"), lambda s: F.length(digits(s)).between(8, 15)),
        "ssn": spans(text, SSN, "-"),
        "account": spans(text, ACCOUNT),
        "hidden_email": spans(text, HIDDEN_EMAIL, "(at", "[at"),
        "name": spans(text, NAME, "mr", "ms", "dr", "prof"),
    }


def _votes(kind: str, s: Column) -> list[Column]:
    """One vote per labeler for a span of this kind."""
    m, near = s["match"], F.lower(F.concat_ws(" ", s["before"], s["after"]))
    yes_no = lambda good, bad: F.when(good, 1).when(bad, -1).otherwise(0)
    one_of = lambda words: r"(?<![a-z])(?:" + "|".join(words) + r")(?![a-z])"
    never = F.lit(False)
    domain = F.lower(F.regexp_extract(m, r"([A-Za-z]+)$", 1))
    strict = {
        "email": yes_no(m.rlike(r"^[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@.*\.[A-Za-z]{2,}$"), m.rlike(r"\.[0-9]+$|\.\.")),
        "ip": yes_no(~m.rlike(r"(^|\.)0[0-9]"), m.rlike(r"^0|(^|\.)0[0-9]")),
        "card": yes_no(m.rlike(r"^[3-6]"), m.rlike(r"^0|^([0-9])\1{7}")),
        "phone": yes_no(m.rlike(r"^\+[1-9]"), m.rlike(r"^\+0|[.]{2}|--")),
        "ssn": yes_no(~m.rlike(r"^(000|666|9)|-00-|-0000$"), m.rlike(r"^(000|666|9)|-00-|-0000$")),
        "account": yes_no(F.length(F.regexp_replace(m, " ", "")).between(15, 34), F.length(m) < 15),
        "hidden_email": yes_no(m.rlike(r"(?i)(dot|\.)\W*[a-z]{2,}$"), m.rlike(r"[0-9]$")),
        "name": yes_no(m.rlike(r"[A-Z][a-z]+ [A-Z][a-z]+$"), never),
    }[kind]
    listed = {
        "email": yes_no(domain.isin(TOP_DOMAINS), domain == ""),
        "ip": yes_no(~m.rlike(r"^(0|127|255)\."), m.rlike(r"^(0|127|255)\.")),
        "card": yes_no(m.rlike(r"^(4|5[1-5]|3[47]|6011|65|2[2-7])"), m.rlike(r"^[01]")),
        "phone": yes_no(m.rlike(r"^\+(" + "|".join(COUNTRY_CODES) + ")"), never),
        "ssn": yes_no(m.rlike(r"^[0-8]"), m.rlike(r"^9")),
        "account": yes_no(F.left(m, F.lit(2)).isin(ACCOUNT_COUNTRIES), ~F.left(m, F.lit(2)).isin(ACCOUNT_COUNTRIES)),
        "hidden_email": yes_no(domain.isin(TOP_DOMAINS), never),
        "name": yes_no(F.regexp_extract(m, r"^([A-Za-z]+)", 1).isin(TITLES), never),
    }[kind]
    around = yes_no(near.rlike(one_of(FOR[kind].split())), near.rlike(one_of(AGAINST)))
    return [v.cast("int") for v in (strict, listed, around)]


def candidates(docs: DataFrame) -> DataFrame:
    """``(doc_id, items)``: every candidate span of each row with its votes, written once without the text."""
    found = _found(F.coalesce(F.col("text"), F.lit("")))

    def voted(k: int, kind: str) -> Column:
        return F.transform(
            found[kind],
            lambda s: F.struct(
                F.lit(k).alias("kind"), s["start"].alias("start"), s["end"].alias("end"),
                *(v.alias(name) for v, name in zip(_votes(kind, s), LABELERS, strict=True)),
            ),
        )

    items = F.concat(*(voted(k, kind) for k, kind in enumerate(KINDS)))
    return materialise(docs.select("doc_id", items.alias("items")), "pii-candidates")


@dataclass(frozen=True)
class Reliability:
    """Of one kind: the share of true spans, and per labeler how often a cast vote is right for true and false spans."""

    prior: float
    right_true: tuple[float, ...]
    right_false: tuple[float, ...]

    def posterior(self, votes: tuple[int, ...]) -> float:
        log_odds = math.log(self.prior / (1 - self.prior))
        for v, t, f in zip(votes, self.right_true, self.right_false, strict=True):
            if v:
                log_odds += math.log(t / (1 - f)) if v > 0 else math.log((1 - t) / f)
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, log_odds))))


def expectation_maximisation(patterns: list[tuple[tuple[int, ...], int]], rounds: int = ROUNDS) -> Reliability:
    """Reliabilities from counted vote patterns of one kind (at most 3 ** labelers of them)."""
    n, (a, b) = len(LABELERS), PRIOR
    model = Reliability(0.5, (a / (a + b),) * n, (a / (a + b),) * n)
    for _ in range(rounds):
        soft = [(votes, count, model.posterior(votes)) for votes, count in patterns]
        true = sum(c * p for _, c, p in soft)
        false = sum(c * (1 - p) for _, c, p in soft)

        def rate(i: int, sign: int, weight, soft=soft) -> float:
            cast = [(v[i], c * weight(p)) for v, c, p in soft if v[i]]
            return (a + sum(w for v, w in cast if v == sign)) / (a + b + sum(w for _, w in cast))

        model = Reliability(
            (true + 1) / (true + false + 2),
            tuple(rate(i, 1, lambda p: p) for i in range(n)),
            tuple(rate(i, -1, lambda p: 1 - p) for i in range(n)),
        )
    return model


def pattern_counts(items: DataFrame) -> DataFrame:
    """``(kind, votes..., n)`` over all candidates; bounded by the number of kinds and vote patterns."""
    return items.select(F.explode("items").alias("i")).select("i.*").groupBy("kind", *LABELERS).agg(F.count("*").alias("n"))


def train(counts: DataFrame) -> tuple[dict[str, float], float, dict[int, Reliability]]:
    """Coefficients and intercept of the span classifier, and the reliabilities its soft labels come from."""
    rows = counts.orderBy("kind", *LABELERS).collect()  # at most kinds * 3 ** labelers rows
    votes = lambda r: tuple(r[name] for name in LABELERS)
    models = {
        k: expectation_maximisation([(votes(r), r["n"]) for r in rows if r["kind"] == k]) for k in {r["kind"] for r in rows}
    }
    names = [f"{name}_{side}" for name in LABELERS for side in ("for", "against")] + [f"kind_{k}" for k in KINDS]
    if not rows:
        return dict.fromkeys(names, 0.0), 0.0, models
    examples = []
    for r in rows:
        p = models[r["kind"]].posterior(votes(r))
        features = [float(v == side) for v in votes(r) for side in (1, -1)] + [float(r["kind"] == k) for k in range(len(KINDS))]
        examples += [(*features, 1.0, r["n"] * p), (*features, 0.0, r["n"] * (1 - p))]
    schema = ", ".join(f"`{c}` double" for c in (*names, "label", "weight"))
    data = VectorAssembler(inputCols=names, outputCol="features").transform(
        counts.sparkSession.createDataFrame(examples, schema).coalesce(1)
    )
    fitted = LogisticRegression(weightCol="weight", regParam=1e-4, maxIter=50, standardization=False).fit(data)
    return dict(zip(names, fitted.coefficients.toArray().tolist(), strict=True)), fitted.intercept, models


def detect(docs: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``(doc_id, found)`` per row: reported spans with kind, start, end and the classifier's probability."""
    items = candidates(docs)
    weight, intercept, _ = train(pattern_counts(items))
    by_kind = F.array(*(F.lit(weight[f"kind_{k}"]) for k in KINDS))

    def probability(i: Column) -> Column:
        score = F.lit(intercept) + F.get(by_kind, i["kind"])
        for name in LABELERS:
            score += F.when(i[name] > 0, weight[f"{name}_for"]).when(i[name] < 0, weight[f"{name}_against"]).otherwise(0.0)
        return 1 / (1 + F.exp(-score))

    scored = F.transform(
        "items",
        lambda i: F.struct(i["kind"].alias("kind"), i["start"].alias("start"), i["end"].alias("end"), probability(i).alias("p")),
    )
    kept = F.filter(scored, lambda i: (i["kind"] < len(BASE)) | (i["p"] >= threshold))
    return items.select("doc_id", F.array_sort(kept).alias("found"))


def listing(found: Column) -> Column:
    """``kind:start:end`` comma-joined, kinds as listed, then by start."""
    name = F.array(*(F.lit(k) for k in KINDS))
    return F.array_join(F.transform(found, lambda i: F.concat_ws(":", F.get(name, i["kind"]), i["start"], i["end"])), ",")


def digest(docs: DataFrame) -> DataFrame:
    """Per row: counts of the base kinds, the digest of the base spans, and all spans as text."""
    found = detect(docs)
    count = lambda k: F.size(F.filter("found", lambda i: i["kind"] == k)).cast("bigint")
    return found.select(
        "doc_id",
        *(count(k).alias(f"n_{kind}") for k, kind in enumerate(BASE)),
        F.sha2(listing(F.filter("found", lambda i: i["kind"] < len(BASE))), 256).alias("base_sha256"),
        listing(F.col("found")).alias("spans"),
    )
