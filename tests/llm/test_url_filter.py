"""Rules, link extraction and propagation against a dense personalised PageRank."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderloom.llm import url_filter

SCHEMA = "page_id bigint, url string, html string, host string, verdict int, mass double"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 0.5) for r in rows], SCHEMA).repartition(3)


@pytest.mark.parametrize(
    "url, host, path, rule",
    [
        ("HTTP://WWW.Example.NET/en/1?a#b", "www.example.net", "/en/1", "example.net/en/"),
        ("https://example.net/EN/1", "example.net", "/EN/1", "net/"),
        ("https://example.net", "example.net", "", None),
        ("https://example.net?x=/en/", "example.net", "", None),
        ("https://a.b.net/#top", "a.b.net", "/", "net/"),
        ("http://badnet/", "badnet", "/", None),
        ("http://net/x", "net", "/x", "net/"),
        ("http://notexample.com/de/", "notexample.com", "/de/", None),
        ("http://x.example.com/de/4", "x.example.com", "/de/4", "example.com/de/"),
        ("http://x.example.com/den", "x.example.com", "/den", None),
        ("ftp://É.Org/fr/a://b", "É.org", "/fr/a://b", "org/fr/"),
        ("http://org/fr", "org", "/fr", None),
        ("mailto:a@b.net", "", "", None),
        ("://", "", "", None),
        ("", "", "", None),
        (None, "", "", None),
    ],
)
def test_rules(spark, url, host, path, rule):
    row = url_filter.judged(pages(spark, [(1, url, None)])).first()
    assert (row["host"], row["path"], row["rule"]) == (host, path, rule)


def test_links(spark):
    html = (
        '<a href="http://B.net/x">1</a> <a HREF=\'//c.org\'>2</a><a class=k href = https://d.com?q>3</a> <a href="/rel">4</a>'
        '<a href="http://a.com/self">5</a><a href="http://b.net/again">6</a> xhref="http://no.com"'
    )
    rows = [(1, "http://A.com/", html), (2, "http://a.com/2", html), (3, "nohost", html), (4, "http://z.com", None)]
    got = sorted(map(tuple, url_filter.links(pages(spark, rows)).collect()))
    assert got == [("a.com", "b.net"), ("a.com", "c.org"), ("a.com", "d.com")]


def dense(n, edges, seed, damping):
    """Fixed point by powers of the whole matrix."""
    move = np.zeros((n, n))
    for a, b in edges:
        move[a, b] = 1
    fan = move.sum(axis=1)
    share = seed / seed.sum()
    for a in range(n):
        move[a] = move[a] / fan[a] if fan[a] else share
    mass = seed.copy()
    for _ in range(500):
        mass = (1 - damping) * seed + damping * mass @ move
    return mass


def test_propagation_against_dense(spark):
    rng = np.random.default_rng(2)
    n = 60
    edges = {(int(a), int(b)) for a, b in rng.integers(0, n, (240, 2)) if a != b}
    edges |= {(a, 7) for a in range(n) if a != 7}  # a hub
    edges = {(a, b) for a, b in edges if a not in (3, 4)}  # no links on
    allowed, blocked = rng.integers(0, 4, n) * (rng.random(n) < 0.3), rng.integers(0, 4, n) * (rng.random(n) < 0.2)
    hosts = spark.createDataFrame([(f"h{i}", 5, int(allowed[i]), int(blocked[i])) for i in range(n - 5)], "host string, pages bigint, allowed bigint, blocked bigint")
    allowed[n - 5 :] = blocked[n - 5 :] = 0  # only linked to
    links = spark.createDataFrame([(f"h{a}", f"h{b}") for a, b in edges], "src string, dst string")
    got = {r.host: r for r in url_filter.propagate(hosts, links, tolerance=1e-9).collect()}
    trust = dense(n, edges, allowed.astype(float), 0.85)
    distrust = dense(n, {(b, a) for a, b in edges}, blocked.astype(float), 0.85)
    assert len(got) == n
    for i in range(n):
        assert got[f"h{i}"].trust == pytest.approx(trust[i], abs=1e-6)
        assert got[f"h{i}"].distrust == pytest.approx(distrust[i], abs=1e-6)


def link(*hosts):
    return " ".join(f'<a href="http://{h}/">x</a>' for h in hosts)


def test_verdicts_spread_over_links(spark):
    rows = [(i, f"http://bad.net/{i}", None) for i in range(20)]
    rows += [(20 + i, f"http://good.org/fr/{i}", link("friend.info")) for i in range(20)]
    rows += [(40, "http://farm.info/", link("bad.net")), (41, "http://farm.info/b", link("bad.net")), (42, "http://friend.info/", link("worse.net"))]
    rows += [(100 + i, f"http://worse.net/{i}", None) for i in range(20)] + [(200 + i, f"http://good.org/fr/+{i}", None) for i in range(40)]
    rows += [(43, "http://alone.info/", None), (44, None, None), (45, "http://good.org/x", None), (46, "http://bad.net", None)]
    rows += [(47, "http://example.net/en/", link("bad.net")), (43, "http://alone.info/", None), (None, "http://alone.info/", None)]
    got = url_filter.verdicts(pages(spark, rows))
    assert got.columns == ["page_id", "host", "path", "rule", "verdict", "excess"] and got.count() == len(rows)
    by = {r.page_id: r for r in got.collect()}
    assert by[40].verdict == by[41].verdict == "block" and by[40].rule is None  # links to a blocked host, trusted by none
    assert by[42].verdict == "allow"  # links to a blocked host too, but a trusted one vouches for it
    assert by[43].verdict == by[44].verdict == by[45].verdict == "allow" and by[44].excess is None
    assert by[46].verdict == "block" and by[46].rule is None  # the path is empty, so no rule fits; its host is distrusted
    assert by[47].verdict == "allow" and by[47].rule == "example.net/en/"
    assert {by[i].verdict for i in range(20)} == {"block"} and {by[i].verdict for i in range(20, 40)} == {"allow"}


def test_without_seeds_or_rows(spark):
    rows = [(1, "http://a.info/", link("b.info")), (2, "http://b.info/", None)]
    assert {r.verdict for r in url_filter.verdicts(pages(spark, rows)).collect()} == {"allow"}
    assert url_filter.verdicts(pages(spark, rows).limit(0)).count() == 0
    assert url_filter.verdicts(pages(spark, rows), rules=()).filter(F.col("rule").isNotNull()).count() == 0
