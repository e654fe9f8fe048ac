"""Rules for addresses, and a reputation of hosts for the pages that no rule names.

A page that a rule names is a labelled outcome, blocked or not. The blocked share of a host is shrunk towards that of its
registered domain, the domain's towards that of its suffix, and the suffix's towards that of all labelled pages: at each
level the parent's mean is the mean of a beta prior, and the weight of the prior comes from how much the groups of
that level differ (the correlation inside groups, by moments). A host is blocked if the lower bound of its posterior
blocked share reaches ``LIMIT``, so a host of which little is known passes.

Only DataFrame functions are used. Lookups by host, domain or suffix split their rows: groups with over a ``SHARE``-th of all
rows, fewer than ``SHARE`` of them, are broadcast; the rest are shuffled, and none of them is large.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyledger.llm.common import stored

SHARE = 1000
#: One-sided 95 % of the posterior, and the blocked share that the bound must reach.
Z, LIMIT = 1.645, 0.5
#: The correlation inside groups stays between these, so that a prior weighs 1/9 of a page at least and 99 pages at most.
LEAST, MOST = 0.01, 0.9
MAX_RULES = 1000
# fixed values: second-level labels under which names are registered in domains of countries
COUNTRY_SECOND = ["ac", "co", "com", "edu", "go", "gob", "gouv", "gov", "govt", "ltd", "me", "mil", "ne", "net", "nom", "or", "org", "plc", "sch"]
_PARTS = ["host", "path", "rule", "verdict", "site", "domain", "suffix"]


class Rule(NamedTuple):
    """``block`` or ``allow`` a host with its subdomains, for paths that begin so: ``example.com/en/``."""

    verdict: str
    pattern: str


RULES = [
    Rule("allow", "com/"), Rule("block", "example.com/en/"), Rule("allow", "www.example.com/en/"), Rule("block", "net/es/"), Rule("block", "net/fr/"),
]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """What stands between ``://`` and the path, with small letters A-Z, and the path; both empty without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return host, F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def site_parts(host: Column) -> tuple[Column, Column, Column]:
    """The host without user and port, its registered domain and its suffix; an address in numbers is its own domain."""
    site = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    labels = F.split(site, r"\.")
    n = F.size(labels)
    country = (n >= 3) & (F.length(F.element_at(labels, -1)) == 2) & F.get(labels, n - 2).isin(COUNTRY_SECOND)
    size = F.when(country, 2).otherwise(1)
    number = site.rlike(r"^[0-9.]*$") | site.startswith("[")
    domain = F.when(number | (n <= size), site).otherwise(F.array_join(F.slice(labels, F.greatest(n - size, F.lit(1)), size + 1), "."))
    suffix = F.when(number, "").otherwise(F.array_join(F.slice(labels, n - size + 1, size), "."))
    return site, domain, suffix


def matched(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one. Of two as long the one with the longer host goes first."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    rule = verdict = F.lit(None).cast("string")
    for kind, pattern in sorted(rules, key=lambda r: (len(r.pattern), r.pattern.find("/"))):
        name, slash, begin = pattern.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + begin)
        rule, verdict = F.when(fits, pattern).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def parsed(pages: DataFrame, url: str, rules: Sequence[Rule], names: Sequence[str] = tuple(_PARTS)) -> DataFrame:
    """Adds the parts of the address, the rule and its verdict under ``names``."""
    named = dict(zip(_PARTS, names))
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    rows = pages.withColumns({named["host"]: host, named["path"]: path})
    rule, verdict = matched(F.col(named["host"]), F.col(named["path"]), rules)
    site, domain, suffix = site_parts(F.col(named["host"]))
    return rows.withColumns({named["rule"]: rule, named["verdict"]: verdict, named["site"]: site, named["domain"]: domain, named["suffix"]: suffix})


def spread_lookup(rows: DataFrame, entries: DataFrame, key: str, weight: str = "pages", share: int = SHARE) -> DataFrame:
    """``rows`` with the entry of their key; each key of ``rows`` is once in ``entries``, with its number of rows as ``weight``."""
    total = entries.agg(F.sum(weight)).head()[0] or 0
    heavy = entries.where(F.col(weight) * share > total)  # fewer than `share` entries, whatever the size of the tables
    light = entries.where(F.col(weight) * share <= total)
    often = rows.join(F.broadcast(heavy), key)
    seldom = rows.join(F.broadcast(heavy.select(key)), key, "left_anti").join(light, key)
    return often.unionByName(seldom)


def _weight(groups: DataFrame) -> Column:
    """The weight of the prior over groups with labelled, blocked and the mean of their parent."""
    n, k, mean = F.col("labelled").cast("double"), F.col("blocked").cast("double"), F.col("parent")
    own = k * (1 - mean) * (1 - mean) + (n - k) * mean * mean
    pairs = ((k - n * mean) * (k - n * mean) - own) / (n - 1)
    alike = F.sum(F.when(n > 1, pairs)) / F.nullif(F.sum(F.when(n > 1, n * mean * (1 - mean))), F.lit(0.0))
    rho = F.least(F.greatest(F.coalesce(alike, F.lit(0.5)), F.lit(LEAST)), F.lit(MOST))
    return (1 - rho) / rho


def _shrunk(groups: DataFrame) -> DataFrame:
    """Groups with a parent's mean, with the posterior numbers of blocked and other pages and the posterior mean."""
    weight = groups.agg(_weight(groups)).head()[0]  # one number
    up, down = F.col("blocked") + weight * F.col("parent"), F.col("labelled") - F.col("blocked") + weight * (1 - F.col("parent"))
    return groups.withColumns({"up": up, "down": down, "mean": up / (up + down)})


def reputations(rows: DataFrame) -> DataFrame:
    """``site, pages, labelled, blocked, mean, bound`` of all hosts of rows with ``site, domain, suffix, verdict`` (null: not labelled)."""
    sums = [F.sum(name).alias(name) for name in ("pages", "labelled", "blocked")]
    sites = stored(rows.groupBy("site", "domain", "suffix").agg(
        F.count("*").alias("pages"), F.count("verdict").alias("labelled"), F.count_if(F.col("verdict") == "block").alias("blocked")
    ), "sites")
    domains = stored(sites.groupBy("domain", "suffix").agg(*sums, F.count("*").alias("sites")), "domains")
    suffixes = stored(domains.groupBy("suffix").agg(*sums, F.count("*").alias("domains")), "suffixes")
    root = suffixes.agg(F.coalesce(F.sum("labelled"), F.lit(0)), F.coalesce(F.sum("blocked"), F.lit(0))).head()
    top = _shrunk(suffixes.withColumn("parent", F.lit((root[1] + 1) / (root[0] + 2))))
    top = top.select("suffix", F.col("mean").alias("parent"), "domains")
    middle = _shrunk(stored(spread_lookup(domains, top, "suffix", "domains").drop("domains"), "domain-means"))
    middle = middle.select("domain", F.col("mean").alias("parent"), F.col("sites").alias("held"))
    hosts = _shrunk(stored(spread_lookup(sites, middle, "domain", "held").drop("held"), "site-means"))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("up") + F.col("down") + 1))
    return stored(hosts.select("site", "pages", "labelled", "blocked", "mean", (F.col("mean") - Z * spread).alias("bound")), "reputations")


def _verdict() -> Column:
    return F.when(F.col("bound") >= LIMIT, "block").otherwise("allow")


def judge(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url", id_column: str = "page_id") -> DataFrame:
    """``page_id, host, path, rule, verdict, labelled, blocked, mean, bound``: every page by its rule, or else by its host.

    ``labelled`` and ``blocked`` count the host's pages with a rule; ``mean`` and ``bound`` are the posterior's, to six digits.
    A null address has an empty host, which has a reputation like any other. Null and repeated ids are judged row by
    row; other columns are not read. Without labelled pages every host passes. No pages, no rows.
    """
    rows = stored(parsed(pages.select(F.col(id_column).alias("page_id"), F.col(url).alias("url")), "url", rules).drop("url"), "addresses")
    known = spread_lookup(rows.withColumnRenamed("verdict", "ruled"), reputations(rows), "site")
    return known.select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", _verdict()).alias("verdict"), "labelled", "blocked",
        F.round("mean", 6).alias("mean"), F.round("bound", 6).alias("bound"),
    )


def allowed(pages: DataFrame, rules: Sequence[Rule] = RULES, url: str = "url") -> DataFrame:
    """The rows of ``pages``, with all their columns, that ``judge`` allows; where a rule decides no lookup is made."""
    mark = "_" * (1 + max([len(name) for name in pages.columns], default=0))  # longer than any name that is there
    names = [mark + part for part in _PARTS]
    rows, named = parsed(pages, url, rules, names), dict(zip(_PARTS, names))
    hosts = reputations(parsed(pages.select(F.col(f"`{url}`").alias("url")), "url", rules)).select(F.col("site").alias(named["site"]), F.col("bound").alias(mark + "bound"), F.col("pages").alias(mark + "pages"))
    ruled = rows.where(F.col(named["verdict"]) == "allow")
    others = spread_lookup(rows.where(F.col(named["verdict"]).isNull()), hosts, named["site"], mark + "pages").where(F.col(mark + "bound") < LIMIT)
    return reduce(DataFrame.unionByName, [part.select(*[F.col(f"`{name}`") for name in pages.columns]) for part in (ruled, others)])
