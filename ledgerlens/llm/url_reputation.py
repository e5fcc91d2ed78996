"""URL filter: rules first, then an empirical-Bayes reputation of the host."""

from __future__ import annotations

import string
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Labels that form a public suffix together with a two-letter country label.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def ascii_lower(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def url_host(url: Column) -> Column:
    """Text between the first ``://`` and the next ``/``, ``?``, ``#`` or the end; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_suffix(host: Column) -> Column:
    """Last label of a host, or its last two where they form a country suffix."""
    pair = rf"(?:^|\.)((?:{'|'.join(SECOND_LEVEL)})\.[a-z]{{2}})$"
    two = F.regexp_extract(host, pair, 1)
    return F.when(two != "", two).otherwise(F.substring_index(host, ".", -1))


def url_domain(host: Column, suffix: Column) -> Column:
    """Registered domain: the suffix and one label more."""
    dots = F.length(suffix) - F.length(F.replace(suffix, F.lit("."), F.lit("")))
    return F.when(dots == 0, F.substring_index(host, ".", -2)).otherwise(
        F.substring_index(host, ".", -3)
    )


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """Name of the longest rule that fits, or null."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.name)):
        below = (host == rule.host) | host.endswith("." + rule.host)
        chosen = F.when(below & path.startswith(rule.path), F.lit(rule.name)).otherwise(chosen)
    return chosen


def _strength(units: DataFrame, weakest: float, strongest: float) -> DataFrame:
    """One row ``m``: pseudo-count of a beta prior shared by units (n, k), by moments.

    The between-unit variance beyond binomial noise gives the intraclass correlation r, and
    m = 1 / r - 1. Fewer than two units, or outcomes all alike, give the strongest prior.
    """
    sums = units.where("n > 0").agg(
        F.count(F.lit(1)).cast("double").alias("units"), F.sum("n").cast("double").alias("n"),
        F.sum("k").cast("double").alias("k"), F.sum(F.col("n") * F.col("n")).cast("double").alias("nn"),
        F.sum(F.col("k") * F.col("k") / F.col("n")).alias("kk"),
    )
    noise = F.expr("(k / n) * (1 - k / n)")
    extra = F.expr("kk - k * k / n") - noise * F.expr("units - 1")
    r = extra / (noise * F.expr("n - nn / n - (units - 1)"))
    m = F.when(F.expr("units < 2 OR k = 0 OR k = n OR n - nn / n - (units - 1) <= 0"), F.lit(strongest))
    m = m.when(extra <= 0, F.lit(strongest)).otherwise(1 / r - 1)
    return sums.select(F.coalesce(F.least(F.greatest(m, F.lit(weakest)), F.lit(strongest)), F.lit(strongest)).alias("m"))


def host_reputation(
    outcomes: DataFrame, *, z: float = 1.645, weakest: float = 1.0, strongest: float = 1000.0
) -> DataFrame:
    """Posterior of the share of bad pages for every host of ``outcomes`` (host, bad).

    ``bad`` is 1, 0, or null for pages without a label; hosts that have only such pages get the
    posterior of their domain. Rates are shrunk level by level: the overall rate (with one bad page in
    ten as its own weak prior, so that a table without labels blocks nothing) is the prior
    mean of a suffix, the suffix of a registered domain, the domain of a host. The pseudo-count
    of each level comes from the spread between its units. Returns host, n, k, rate and bound
    (rate minus ``z`` posterior standard deviations).

    A hot host is summed before the shuffle; the tables behind it hold one row per host.
    """
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum(F.col("bad").cast("long")), F.lit(0)).alias("k")
    )
    hosts = hosts.withColumn("suffix", url_suffix(F.col("host")))
    hosts = hosts.withColumn("domain", url_domain(F.col("host"), F.col("suffix")))
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    overall = suffixes.agg(((F.sum("k") + 1.0) / (F.sum("n") + 10.0)).alias("rate"))

    def shrunk(units: DataFrame, prior: DataFrame, on: str | None) -> DataFrame:
        prior = prior.select(*([on] if on else []), F.col("rate").alias("prior"))
        joined = units.join(prior, on, "left") if on else units.crossJoin(F.broadcast(prior))
        joined = joined.crossJoin(F.broadcast(_strength(units, weakest, strongest)))  # one row
        a, b = F.expr("k + m * prior"), F.expr("n - k + m * (1 - prior)")
        deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
        return joined.withColumn("rate", a / (a + b)).withColumn("bound", F.col("rate") - z * deviation)

    suffixes = shrunk(suffixes, overall, None)
    domains = shrunk(domains, suffixes, "suffix")
    return shrunk(hosts, domains, "domain").select("host", "n", "k", "rate", "bound")


def filter_urls(
    pages: DataFrame, rules: Sequence[Rule], *, bad: Column | None = None, worst: float = 0.25, z: float = 1.645
) -> DataFrame:
    """Judge every row of ``pages`` (page_id, url) by rules, then by the host's reputation.

    ``bad`` is the labelled outcome of a page (1 bad, 0 good, null unlabelled). Pages that no
    rule fits are blocked where the lower posterior bound of the host's share of bad pages is
    above ``worst``. Null urls, and urls without ``://``, have empty host and path, fit no rule,
    and share the reputation of the empty host. Every input row gives one row, repeated and null
    ids included; other columns of ``pages`` are not read. An empty table gives no rows.
    """
    bad = F.lit(None).cast("int") if bad is None else bad
    judged = pages.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), bad.alias("bad"))
    reputation = host_reputation(judged.select("host", "bad"), z=z)
    rule = fitting_rule(F.col("host"), F.col("path"), rules)
    by_rule = F.lit(None).cast("string")
    for r in rules:
        by_rule = F.when(F.col("rule") == r.name, r.verdict).otherwise(by_rule)
    verdict = F.coalesce(by_rule, F.when(F.col("bound") > worst, "block").otherwise("allow"))
    return (
        judged.drop("bad").join(reputation, "host", "left").withColumn("rule", rule)
        .select("page_id", "host", "path", "rule", verdict.alias("verdict"), "n", "k", "rate", "bound")
    )
