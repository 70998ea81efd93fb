from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from renewlens.llm import catalog
from renewlens.llm.host_reputation import Policy, host, judge, path, registered_domain, suffix

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
URLS = [
    None, "", "no scheme", "http://", "http://A.Example.NET", "http://a.example.net/en/1?x=/de/",
    "HTTP://É.Example.com/de/#t", "x://y://z/a", "http://h?p=http://other/b", "http://h#f/g",
    "http://h//double", "http://a\nb.net/x\ny", "http://notnet/", "http://net/fr/", "://org/fr/x",
    "http://deep.sub.example.net/en", "http://example.net/en/", "http://user@h.org:80/fr/",
    "http://EXAMPLE.COM/de/1", "http://example.com/De/1", "http://xexample.net/en/9",
]
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([i for i in (rest.find(c) for c in "/?#") if i >= 0], default=len(rest))
    return rest[:cut].translate(LOWER), re.split("[?#]", rest[cut:])[0]


def ruled(name, route):
    fits = [
        r
        for r in RULES
        if (name == r.split("/")[0] or name.endswith("." + r.split("/")[0]))
        and route.startswith("/" + r.split("/", 1)[1])
    ]
    return max(fits, key=len, default=None)


def pages(spark, rows):
    full = [(i, u, "<p>", "h", "r", 1.0, 2) for i, u in rows]
    kind = "page_id long, url string, html string, host string, rule string, mean double, n long"
    return spark.createDataFrame(full, kind)


def outcomes(spark, rows):
    return spark.createDataFrame(rows, "page_id long, good int")


def test_parts_and_rules(spark):
    df = pages(spark, list(enumerate(URLS)))
    parts = df.select("page_id", host(F.col("url")), path(F.col("url"))).collect()
    assert {r[0]: (r[1], r[2]) for r in parts} == {i: split(u) for i, u in enumerate(URLS)}
    found = judge(df, outcomes(spark, []), catalog.POLICY).collect()
    assert len(found) == len(URLS)
    for r in found:
        name, route = split(URLS[r.page_id])
        assert (r.host, r.path, r.rule) == (name, route, ruled(name, route))
        assert r.verdict == RULES.get(r.rule, "allow")


def test_domains(spark):
    names = ["a.b.co.uk", "co.uk", "x.example.com", "com", "", "10.0.0.1", "u@w.b.org:80", "b.org."]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = df.select(registered_domain(F.col("n"), Policy()), suffix(F.col("n"), Policy())).collect()
    assert [tuple(r) for r in got] == [
        ("b.co.uk", "co.uk"), ("co.uk", "co.uk"), ("example.com", "com"), ("com", "com"), ("", ""),
        ("10.0.0.1", "1"), ("b.org", "org"), ("b.org", "org"),
    ]


def test_suffix_rules_with_stars_and_exceptions(spark):
    policy = Policy(long_suffixes=("uk", "co.uk", "github.io", "*.ck", "!www.ck", "b.c.kobe.jp"))
    want = {
        "a.b.co.uk": ("co.uk", "b.co.uk"),
        "co.uk": ("co.uk", "co.uk"),
        "b.uk": ("uk", "b.uk"),
        "me.github.io": ("github.io", "me.github.io"),
        "x.me.github.io": ("github.io", "me.github.io"),
        "a.b.other.ck": ("other.ck", "b.other.ck"),
        "other.ck": ("other.ck", "other.ck"),
        "ck": ("ck", "ck"),
        "a.www.ck": ("ck", "www.ck"),
        "www.ck": ("ck", "www.ck"),
        "x.b.c.kobe.jp": ("b.c.kobe.jp", "x.b.c.kobe.jp"),
        "x.c.kobe.jp": ("jp", "kobe.jp"),
        "noco.uk": ("uk", "noco.uk"),
    }
    df = spark.createDataFrame([(n,) for n in want], "n string")
    got = df.select("n", suffix(F.col("n"), policy), registered_domain(F.col("n"), policy))
    assert {r[0]: (r[1], r[2]) for r in got.collect()} == want


def test_pages_are_read_twice(spark):
    """Once for the hosts' counts, once for the verdicts; the rest reads the counts."""
    found = catalog.op2_host_reputation(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("pages.parquet") == 1 and "labels.parquet" not in plan


def test_shrinkage(spark):
    rows, good, k = [], [], 0
    for name, n, share in [("bad.x.com", 200, 0.02), ("fine.x.com", 200, 0.9), ("few.x.com", 2, 0.0),
                           ("few.y.com", 2, 0.0), ("big.y.com", 300, 0.95), ("none.y.com", 0, 0)]:
        for j in range(max(n, 1)):
            rows.append((k, f"http://{name}/p{j}"))
            if n:
                good.append((k, int(j >= n * (1 - share))))
            k += 1
    found = {r.host: r for r in judge(pages(spark, rows), outcomes(spark, good), Policy()).collect()}
    assert found["bad.x.com"].verdict == "block" and found["fine.x.com"].verdict == "allow"
    # Two bad outcomes do not outweigh a good domain.
    assert found["few.y.com"].verdict == "allow"
    assert found["few.y.com"].good_share > found["few.x.com"].good_share
    assert found["none.y.com"].n_outcomes == 0 and found["none.y.com"].verdict == "allow"
    assert found["bad.x.com"].good_share == pytest.approx(0.02, abs=0.02)


def test_no_rows_nulls_and_repeats(spark):
    assert judge(pages(spark, []), outcomes(spark, []), Policy()).collect() == []
    rows = [(None, "http://a.b/"), (1, "http://a.b/"), (1, "http://a.b/"), (2, "http://" + "x" * 99_999)]
    found = judge(pages(spark, rows), outcomes(spark, [(1, 0), (1, 1), (None, 0)]), Policy()).collect()
    assert sorted((r.page_id or 0, r.n_outcomes) for r in found) == [(0, 2), (1, 2), (1, 2), (2, 0)]


def test_native(spark):
    found = catalog.op2_host_reputation(spark, "/root/testdata/sf0.001")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "html" not in plan
