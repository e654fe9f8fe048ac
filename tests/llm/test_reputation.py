"""Addresses and rules against Python's own reading of them, shrunk shares against a plain version."""

from __future__ import annotations

import math
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from skyledger.llm import url_reputation as U

URLS = [
    None, "", "no address", "http://", "://x", "http://Example.COM/en/1", "https://www.example.com/en/1?q=/x", "http://example.com/en", "http://a.b.net/es/", "http://net/fr/x#y",
    "http://notnet.org/es/", "http://xnet/es/", "http://com?x=/en/", "http://com#a/b", "http://com", "ftp://u:p@shop.co.uk:80/es/a://b", "http://ÄÖ.net/fr/é?x",
    "http://10.0.0.1:8080/fr/", "http://[::1]/x", "a://b://c/d", "http://x.net\n/es/", "http://www.example.com.au/en/", "http://.com/", "http://b.com//en/",
]


def _plain(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    found = re.match(r"([^/?#]*)([^?#]*)", rest)
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in found[1])
    return host, found[2]


def _rule(host, path, rules=U.RULES):
    best = None
    for rule in rules:
        name, slash, begin = rule.pattern.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + begin) and (best is None or len(rule.pattern) > len(best.pattern)):
            best = rule
    return best


def _site(host):
    site = re.sub(r":[0-9]*$", "", re.sub(r"^.*@", "", host))
    labels = site.split(".")
    if re.fullmatch(r"[0-9.]*", site) or site.startswith("["):
        return site, site, ""
    size = 2 if len(labels) >= 3 and len(labels[-1]) == 2 and labels[-2] in U.COUNTRY_SECOND else 1
    return site, ".".join(labels[-size - 1 :]), ".".join(labels[-size:])


def _prior(groups):
    up = down = 0.0
    for n, k, p in groups:
        if n > 1:
            up += ((k - n * p) ** 2 - (k * (1 - p) ** 2 + (n - k) * p * p)) / (n - 1)
            down += n * p * (1 - p)
    rho = min(max(up / down if down else 0.5, U.LEAST), U.MOST)
    return (1 - rho) / rho


def _brute(urls):
    counts = [defaultdict(lambda: [0, 0]) for _ in range(3)]
    parents = [{}, {}]
    parts = [_plain(u) for u in urls]
    for host, path in parts:
        site, domain, suffix = _site(host)
        parents[0][site], parents[1][domain] = domain, suffix
        rule = _rule(host, path)
        for level, key in enumerate((site, domain, suffix)):
            counts[level][key][0] += rule is not None
            counts[level][key][1] += rule is not None and rule.verdict == "block"
    n, k = (sum(v[i] for v in counts[2].values()) for i in (0, 1))
    means = {s: (k + 1) / (n + 2) for s in counts[2]}
    for level in (2, 1, 0):
        prior = _prior([(*counts[level][key], means[key]) for key in counts[level]])
        post = {key: (v[1] + prior * means[key], v[0] - v[1] + prior * (1 - means[key])) for key, v in counts[level].items()}
        if level:
            means = {key: post[parent][0] / sum(post[parent]) for key, parent in parents[level - 1].items()}
    out = []
    for host, path in parts:
        a, b = post[_site(host)[0]]
        mean = a / (a + b)
        bound = mean - U.Z * math.sqrt(mean * (1 - mean) / (a + b + 1))
        rule = _rule(host, path)
        out.append((host, path, rule and rule.pattern, rule.verdict if rule else "block" if bound >= U.LIMIT else "allow", mean, bound))
    return out


def _key(row):
    return tuple(str(v) for v in row[:4])


def test_against_plain_version(spark):
    hot = [f"http://hot.example.net/{lang}/{k}" for k in range(300) for lang in ("es", "en")]
    mixed = [f"https://h{k % 7}.d{k % 3}.com/en/{k}" for k in range(90)] + [f"http://h{k % 5}.example.com/{('en', 'de')[k % 2]}/" for k in range(60)]
    urls = URLS + hot + mixed + [f"http://n{k}.d{k % 4}.net/{('fr', 'de', 'en')[k % 3]}/" for k in range(80)] + ["http://lone.org/a"] * 2
    pages = spark.createDataFrame([(None if k == 3 else k // 2, u, "h") for k, u in enumerate(urls)], "page_id bigint, url string, html string")
    pages = pages.withColumns({name: F.lit("x") for name in ("host", "site", "verdict", "mean", "pages", "parent", "bound")})
    found = U.judge(pages)
    got = sorted(((r["host"], r["path"], r["rule"], r["verdict"], r["mean"], r["bound"]) for r in found.collect()), key=_key)
    want = sorted(_brute(urls), key=_key)
    assert [row[:4] for row in got] == [row[:4] for row in want]
    assert [x for row in got for x in row[4:]] == pytest.approx([x for row in want for x in row[4:]], abs=2e-6)
    verdicts = {r["verdict"] for r in found.where("rule is null").collect()}
    assert verdicts == {"allow", "block"}
    kept = U.allowed(pages)
    assert kept.columns == pages.columns
    allowed = [u for u, row in zip(urls, _brute(urls)) if row[3] == "allow"]
    assert sorted(r["url"] or "" for r in kept.collect()) == sorted(u or "" for u in allowed)


def test_longest_rule_and_limits(spark):
    rules = [U.Rule("block", "a.com/x/"), U.Rule("allow", "com/xyz/z"), U.Rule("allow", "b.a.com/")]
    rows = spark.createDataFrame([("http://b.a.com/x/1",), ("http://b.a.com/xyz/z",), ("http://c.com/xyz/z",)], "url string")
    found = {(r["host"], r["path"]): r["rule"] for r in U.parsed(rows, "url", rules).collect()}
    # equal lengths: the longer host goes first
    assert found == {("b.a.com", "/x/1"): "b.a.com/", ("b.a.com", "/xyz/z"): "com/xyz/z", ("c.com", "/xyz/z"): "com/xyz/z"}
    with pytest.raises(ValueError):
        U.parsed(rows, "url", rules * 400)


def test_nothing_to_learn_from(spark):
    pages = spark.createDataFrame([(1, "http://x.org/a"), (2, None)], "page_id bigint, url string")
    assert {r["verdict"] for r in U.judge(pages).collect()} == {"allow"}
    assert U.judge(pages.limit(0)).count() == 0 and U.allowed(pages.limit(0)).count() == 0
    assert U.judge(pages, rules=[]).count() == 2


def test_lookup_keeps_every_row(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), (F.col("id") % 4000).cast("string"))).alias("key"), "id")
    entries = rows.groupBy("key").agg(F.count("*").alias("pages"), F.min("id").alias("least"))
    assert U.spread_lookup(rows, entries, "key").agg(F.count("*"), F.count_distinct("id")).head()[:] == (20_000, 20_000)


def test_no_python_in_the_plan(spark):
    from skyledger.llm.queries import op11_host_reputation

    plan = op11_host_reputation(spark, "/root/testdata/sf0.001")._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)
