from __future__ import annotations

import math

import pytest

from boardlens.llm import host_reputation as hr
from boardlens.llm.queries import ORACLES, QUERIES
from tests.oracle import connect, differences


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_given_pages_match_sql(spark, sf):
    name, root = "op6_host_reputation", f"/root/testdata/sf{sf}"
    assert not differences(connect(root), ORACLES[name], QUERIES[name](spark, root))


def test_urls_and_rules(spark):
    want = {
        "https://WWW.Example.com/en/x?y#z": ("www.example.com", "/en/x", "www.example.com/en/", "allow"),
        "http://a.example.com/en/": ("a.example.com", "/en/", "example.com/en/", "block"),
        "http://badexample.com/en/": ("badexample.com", "/en/", "com/", "allow"),
        "http://net/fr/a": ("net", "/fr/a", "net/fr/", "block"),
        "http://x.net/fr": ("x.net", "/fr", None, "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "a://b://c/d": ("b:", "//c/d", None, "allow"),
        "x.com/en/": ("", "", None, "allow"),
        "http://É.net/es/#q": ("É.net", "/es/", "net/es/", "block"),
        "http://x.com?q=/en/": ("x.com", "", None, "allow"),
        "://": ("", "", None, "allow"),
        "http://h:80/a\nb": ("h:80", "/a\nb", None, "allow"),
        None: ("", "", None, "allow"),
    }
    pages = spark.createDataFrame([(i, u, "x", 1) for i, u in enumerate(want)], "page_id long, url string, host string, bad int")
    none = spark.createDataFrame([], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in hr.judge(pages, none, max_bad=0.999).collect()}
    assert got == dict(enumerate(want.values()))
    assert hr.judge(pages.limit(0), none).count() == 0


def test_shrinkage_from_suffix_to_host(spark):
    """A host with much evidence keeps its share; one with none takes its domain's."""
    rows, outcomes, n = [], [], 0
    for host, bad, good, more in [("a.bad.org", 90, 10, 5), ("b.bad.org", 80, 20, 5), ("c.bad.org", 0, 0, 5), ("a.good.org", 2, 98, 5),
                                  ("b.good.org", 1, 60, 5), ("new.good.org", 0, 0, 5), ("x.co.uk", 0, 3, 2), (None, 0, 1, 1)]:
        for k in range(bad + good + more):
            rows.append((n, f"http://{host}/p" if host else None))
            if k < bad + good:
                outcomes += [(n, int(k < bad)), (n, 0), (n, None)]
            n += 1
    out = hr.judge(spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad int")).collect()
    by = {r.host: r for r in out}
    assert len(out) == len(rows) and all(math.isfinite(r.bad_bound) for r in out)
    assert by["c.bad.org"].verdict == "block" and by["new.good.org"].verdict == "allow"
    assert 0.8 < by["a.bad.org"].bad_share < 0.92 and by["a.good.org"].bad_share < 0.06
    assert by["new.good.org"].bad_bound > by["a.good.org"].bad_bound


def test_registered_domains(spark):
    from pyspark.sql import functions as F

    hosts = ["a.b.example.com", "example.com", "com", "", "u:p@x.y.co.uk:80", "co.uk", "x.org."]
    domain, suffix = hr.domain_and_suffix(F.col("h"))
    got = [tuple(r) for r in spark.createDataFrame([(h,) for h in hosts], "h string").select(domain, suffix).collect()]
    assert got == [("example.com", "com"), ("example.com", "com"), ("com", "com"), ("", ""), ("y.co.uk", "co.uk"), ("co.uk", "co.uk"), ("x.org", "org")]


def test_a_table_of_suffixes(spark):
    hosts = ["a.x.com.cn", "y.com.cn", "com.cn", "p.github.io", "q.github.io", "u@z.b.c.kobe.jp:8", "w.plain.org", "10.0.7.9", "[::1]:80", ""]
    rows = spark.createDataFrame([(h, 1, 0) for h in hosts], "host string, n long, bad long")
    listed = spark.createDataFrame([(s,) for s in ["cn", "com.cn", "COM.CN", "io", "github.io", "jp", "c.kobe.jp"]], "suffix string")
    got = {r.host: (r.domain, r.suffix) for r in hr.with_domains(rows, listed).collect()}
    assert got == {
        "a.x.com.cn": ("x.com.cn", "com.cn"), "y.com.cn": ("y.com.cn", "com.cn"), "com.cn": ("com.cn", "com.cn"),
        "p.github.io": ("p.github.io", "github.io"), "q.github.io": ("q.github.io", "github.io"),
        "u@z.b.c.kobe.jp:8": ("b.c.kobe.jp", "c.kobe.jp"), "w.plain.org": ("plain.org", "org"),
        "10.0.7.9": ("10.0.7.9", "[ip]"), "[::1]:80": ("[::1]", "[ip]"), "": ("", ""),
    }
    plain = {r.host: r.domain for r in hr.with_domains(rows).collect()}
    assert plain["10.0.7.9"] == "10.0.7.9" and plain["a.x.com.cn"] == "com.cn"


def test_sites_below_a_listed_suffix_are_judged_apart(spark):
    """Many bad sites below one suffix do not carry over to a host of another registered domain as its own domain would."""
    hosts = [("evil.github.io", 1, 60), ("www.good.github.io", 0, 60), ("new.good.github.io", None, 1)]
    rows, outcomes = [], []
    for h, bad, n in hosts:
        for _ in range(n):
            rows.append((len(rows), f"http://{h}/"))
            if bad is not None:
                outcomes.append((len(rows) - 1, bad))
    pages, labels = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(outcomes, "page_id long, bad int")
    share = lambda s: {r.host: r.bad_share for r in hr.judge(pages, labels, suffixes=s).collect()}["new.good.github.io"]
    assert share(spark.createDataFrame([("github.io",)], "suffix string")) < 0.2 < 0.4 < share(None)
