"""URL filter: rules first, else an empirical-Bayes reputation of the host.

Labelled page outcomes are counted by host, registered domain and public suffix. Each level is a beta-binomial whose
prior mean is the posterior mean of the level above and whose prior strength comes from the over-dispersion that the
groups of the level show (method of moments). A host passes if the lower bound of its posterior is high enough.
Everything is DataFrame work: two counts with map-side sums, joins on unique keys that adaptive execution splits when
one host holds many pages, and one row of three numbers per level on the driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Second-level labels under which two-letter suffixes register names.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")
#: Posterior standard deviations below the mean, and the least lower bound of a host that passes.
Z, LEAST = 1.645, 0.7
#: Bounds of the intra-group correlation; its inverse less one is the prior's strength.
LEAST_RHO, MOST_RHO = 0.0001, 0.9


@dataclass(frozen=True)
class Rule:
    """allow or block for a host and its subdomains where the path starts with the rule's."""

    pattern: str
    verdict: str

    @property
    def host(self) -> str:
        return self.pattern.split("/", 1)[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.split("/", 1)[1]


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty if the url is null or has no `://`."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + 3)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    return F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def rule_for(host: Column, path: Column, rules: list[Rule], what: str) -> Column:
    """`pattern` or `verdict` of the longest rule that fits; null if none does."""
    out: Column = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        fits = ((host == rule.host) | host.endswith(f".{rule.host}")) & path.startswith(rule.path)
        out = F.when(fits, F.lit(getattr(rule, what))).otherwise(out)
    return out


def registered_domain(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host without its port; a host of one label, or of digits and dots, is both."""
    name = F.regexp_replace(host, ":[0-9]*$", "")
    double = name.rlike(rf"\.({'|'.join(SECOND_LEVEL)})\.[a-z]{{2}}$")
    plain = ~name.contains(".") | name.rlike("^[0-9.]+$")
    suffix = F.when(plain, name).when(double, F.substring_index(name, ".", -2)).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(plain, name).when(double, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))
    return domain, suffix


def _strength(groups: DataFrame) -> float:
    """Prior strength from groups with n outcomes, k good ones and prior mean m: one row comes back."""
    expected = F.col("n") * F.col("m") * (1 - F.col("m"))
    row = groups.select(F.sum((F.col("k") - F.col("n") * F.col("m")) ** 2 - expected).alias("over"), F.sum(expected * (F.col("n") - 1)).alias("room")).first()
    rho = row.over / row.room if row.room else LEAST_RHO
    return 1 / min(max(rho, LEAST_RHO), MOST_RHO) - 1


def _shrunk(strength: float) -> Column:
    return (F.col("k") + strength * F.col("m")) / (F.col("n") + strength)


def host_posteriors(pages: DataFrame, outcomes: DataFrame) -> DataFrame:
    """(host, domain, suffix, n, k, prior, posterior, lower) for every host of pages.

    outcomes: page_id and good (true or false; null rows and rows without a page are ignored). Without any outcome
    the prior mean is one half. Pages without a host give no row."""
    url_host, _ = split_url(F.col("url"))
    seen = pages.select("page_id", url_host.alias("host")).filter("host <> ''")
    known = outcomes.select("page_id", F.col("good").cast("boolean").cast("int").alias("good")).dropna()
    counts = seen.join(known, "page_id", "left").groupBy("host").agg(F.count("good").cast("double").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("k"))
    domain, suffix = registered_domain(F.col("host"))
    hosts = cut_lineage(counts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "k"))
    domains = cut_lineage(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k")))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    n, k = suffixes.agg(F.sum("n"), F.sum("k")).first()
    suffixes = suffixes.withColumn("m", F.lit((k / n) if n else 0.5))
    suffixes = suffixes.select("suffix", _shrunk(_strength(suffixes)).alias("m"))
    domains = domains.join(suffixes, "suffix")
    domains = domains.select("domain", _shrunk(_strength(domains)).alias("m"))
    hosts = hosts.join(domains, "domain")
    strength = _strength(hosts)
    a, b = F.col("k") + strength * F.col("m"), F.col("n") - F.col("k") + strength * (1 - F.col("m"))
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.select("host", "domain", "suffix", "n", "k", F.col("m").alias("prior"), (a / (a + b)).alias("posterior"), F.round(a / (a + b) - Z * deviation, 6).alias("lower"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], least: float = LEAST) -> DataFrame:
    """(page_id, host, path, rule, verdict, lower) for every row of pages, repeated rows included.

    verdict: the longest fitting rule's; else allow if the host's lower bound is at least `least`, else block. Pages
    without a host are blocked, and their lower bound is null. Other columns of pages are left out."""
    host, path = split_url(F.col("url"))
    rows = pages.select("page_id", host.alias("host"), path.alias("path"))
    bounds = host_posteriors(pages, outcomes).select("host", "lower")
    rule = rule_for(F.col("host"), F.col("path"), rules, "pattern")
    by_rule = rule_for(F.col("host"), F.col("path"), rules, "verdict")
    by_host = F.when(F.col("lower") >= least, "allow").otherwise("block")
    return rows.join(bounds, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(by_rule, by_host).alias("verdict"), "lower")
