"""URL filters by empirical-Bayes host reputation, in DataFrame functions.

Labelled page outcomes (bad or not) are counted by host, registered domain and suffix. The
rate of each level is a beta distribution: the prior of a host is its domain's posterior
mean, that of a domain its suffix's, that of a suffix the rate of all pages. How many pages
a prior is worth is estimated by the method of moments from how far the rates below differ
by more than chance. A host is blocked if even a low bound of its posterior rate reaches
the limit: few bad pages do not block a host, and a bad neighbourhood alone does not
either. Fixed rules on host and path come first; the longest that fits wins.

All counts are partial sums before any shuffle, so a host with a third of the pages is one
row from each task. Scores are joined back by host; Spark splits a host that is too large
for one task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Policy:
    """Limit of the bad rate, standard deviations of the bound, and the range of pages that a prior is worth."""

    limit: float = 0.5
    deviations: float = 1.645
    least_pages: float = 2.0
    most_pages: float = 1000.0


# Verdict and rule, host before the first slash.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)


def host_of(url: Column) -> Column:
    """What stands after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1)
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(low, F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def registered_domain(host: Column) -> Column:
    """The last two labels of a host (all of it, if it has fewer)."""
    return F.substring_index(host, ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def fitting_rule(host: Column, path: Column, rules: tuple[tuple[str, str], ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits a host or a domain above it, and starts the path; else null."""
    name = verdict = F.lit(None).cast("string")
    for decided, rule in sorted(rules, key=lambda x: (len(x[1]), x[1])):
        domain, _, start = rule.partition("/")
        fits = ((host == domain) | F.endswith(host, F.lit("." + domain))) & F.startswith(path, F.lit("/" + start))
        name = F.when(fits, F.lit(rule)).otherwise(name)
        verdict = F.when(fits, F.lit(decided)).otherwise(verdict)
    return name, verdict


def _worth(below: DataFrame, key: str, policy: Policy) -> DataFrame:
    """Rate of each ``key`` and the pages its rate is worth as a prior, from the counts of the level below."""
    rate = F.col("bad") / F.col("pages")
    sums = below.where("pages > 0").groupBy(key).agg(
        F.count("*").alias("k"),
        F.sum("pages").alias("pages"),
        F.sum("bad").alias("bad"),
        F.sum(F.col("pages") * F.col("pages")).alias("squares"),
        F.sum(F.col("pages") * rate * rate).alias("spread"),
    )
    mean = F.col("bad") / F.col("pages")
    chance = mean * (1 - mean)
    # Weighted variance of the rates, less what chance gives, over what is left if pages of one host were all alike.
    between = F.col("spread") - F.col("pages") * mean * mean - (F.col("k") - 1) * chance
    scale = (F.col("pages") - F.col("squares") / F.col("pages")) - (F.col("k") - 1)
    share = F.when((scale > 0) & (chance > 0), between / (scale * chance)).otherwise(F.lit(0.0))
    worth = F.when(share > 0, 1 / share - 1).otherwise(F.lit(policy.most_pages))
    worth = F.least(F.greatest(worth, F.lit(policy.least_pages)), F.lit(policy.most_pages))
    return sums.select(key, "pages", "bad", worth.alias("worth"))


def _posterior(level: DataFrame, prior: Column, worth: Column) -> tuple[Column, Column]:
    pages, bad = F.coalesce(level["pages"], F.lit(0)), F.coalesce(level["bad"], F.lit(0))
    return prior * worth + bad, (1 - prior) * worth + pages - bad


def host_scores(hosts: DataFrame, policy: Policy = Policy()) -> DataFrame:
    """Posterior ``mean`` and low ``bound`` of the bad rate, of hosts with their labelled ``pages`` and ``bad`` ones.

    A host without labelled pages has the mean of its domain and the spread of its prior.
    Without any labelled page at all the rate of all pages counts as 0.
    """
    hosts = hosts.withColumns({"domain": registered_domain(F.col("host")), "suffix": suffix_of(F.col("host"))})
    hosts = hosts.withColumn("every", F.lit(1))
    domain_of = hosts.groupBy("domain", "suffix", "every").agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"))
    suffixes = domain_of.groupBy("suffix", "every").agg(F.sum("pages").alias("pages"), F.sum("bad").alias("bad"))
    rename = lambda df, key, tag: df.select(key, F.col("worth").alias(f"{tag}_worth"))
    root = _worth(suffixes, "every", policy).select(
        "every", (F.col("bad") / F.col("pages")).alias("rate"), F.col("worth").alias("all_worth")
    )
    rate, most = F.coalesce("rate", F.lit(0.0)), F.lit(policy.most_pages)
    level = suffixes.join(root, "every", "left").join(rename(_worth(domain_of, "suffix", policy), "suffix", "s"), "suffix", "left")
    a, b = _posterior(level, rate, F.coalesce("all_worth", most))
    level = level.select("suffix", (a / (a + b)).alias("s_mean"), F.coalesce("s_worth", most).alias("s_worth"))
    level = domain_of.join(level, "suffix").join(rename(_worth(hosts, "domain", policy), "domain", "d"), "domain", "left")
    a, b = _posterior(level, level["s_mean"], level["s_worth"])
    level = level.select("domain", (a / (a + b)).alias("d_mean"), F.coalesce("d_worth", most).alias("d_worth"))
    level = hosts.join(level, "domain")
    a, b = _posterior(level, level["d_mean"], level["d_worth"])
    mean = a / (a + b)
    deviation = F.sqrt(mean * (1 - mean) / (a + b + 1))
    return level.select("host", mean.alias("mean"), F.greatest(mean - policy.deviations * deviation, F.lit(0.0)).alias("bound"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    policy: Policy = Policy(),
    rules: tuple[tuple[str, str], ...] = RULES,
    key: str = "page_id",
    url: str = "url",
) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, and the host's posterior ``bad_rate`` and ``low_bound``, of every page.

    ``outcomes(page_id, bad)`` labels some pages; an id labelled twice is bad if one label
    says so, null ids and labels are ignored. Without a fitting rule the method decides.
    A null url, or one without ``://``, has an empty host and path, and the empty host is
    judged like any other. Repeated pages repeat (each counts); an empty table gives an
    empty result; other columns play no part.
    """
    places = pages.select(pages[key].alias("page_id"), host_of(pages[url]).alias("host"), path_of(pages[url]).alias("path"))
    known = outcomes.select(F.col("page_id").alias("_page"), F.col("bad").cast("int").alias("_bad"))
    known = known.where("_page is not null and _bad is not null").groupBy("_page").agg(F.max("_bad").alias("_bad"))
    told = places.select("page_id", "host").join(known, places["page_id"] == known["_page"], "left")
    hosts = told.groupBy("host").agg(F.count("_bad").alias("pages"), F.coalesce(F.sum("_bad"), F.lit(0)).alias("bad"))
    scores = host_scores(hosts, policy)
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col("bound") >= policy.limit, F.lit("block")).otherwise(F.lit("allow"))
    return places.join(scores, "host", "left").select(
        "page_id",
        "host",
        "path",
        rule.alias("rule"),
        F.coalesce(verdict, own).alias("verdict"),
        F.round("mean", 9).alias("bad_rate"),
        F.round("bound", 9).alias("low_bound"),
    )
