"""URL filters: rules by host and path prefix, and an empirical-Bayes reputation of hosts for the rest.

Labelled outcomes of pages (good or not) are counted per host. The rate of a host is shrunk to that of
its registered domain, that to its suffix, and that to all pages, through beta-binomial priors. The
strength of the prior at each level is estimated by moments: the more the children of a level differ
beyond chance, the weaker the pull. A host is blocked when even a high quantile of its posterior stays
under the least good rate; hosts without labels have their domain's posterior, and pass unless that is
bad for sure.

Defined cases: a NULL url, or one without ``://``, has an empty host and path and no rule; NULL labels are
no labels; without any labels everything passes. Repeated pages are rows of their own; repeated labels
count again. Only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskbook.llm.common import stored, whole

# (verdict, host, path prefix) as the contract states them.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
# Suffixes of more than one label under which domains are registered; a parameter.
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.nz", "co.za")

LEAST_GOOD_RATE = 0.6
BOUND_DEVIATIONS = 1.645  # one-sided 95 %
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 1000.0
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_host(url: str | Column) -> Column:
    host = F.regexp_extract(whole(url), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER)


def url_path(url: str | Column) -> Column:
    return F.regexp_extract(whole(url), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def suffix(host: Column) -> Column:
    last_two = F.substring_index(host, ".", -2)
    return F.when(last_two.isin(*LONG_SUFFIXES), last_two).otherwise(F.substring_index(host, ".", -1))


def registered_domain(host: Column) -> Column:
    """The suffix and one label more; an address of numbers is its own domain."""
    long = F.substring_index(host, ".", -2).isin(*LONG_SUFFIXES)
    named = F.when(long, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))
    return F.when(host.rlike(r"^[0-9.]+$"), host).otherwise(named)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """The longest fitting rule as a struct (rule, verdict), or NULL."""
    chosen = F.lit(None).cast("struct<rule:string,rule_verdict:string>")
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(
            F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("rule_verdict")
        )
        chosen = F.when(fits, value).otherwise(chosen)
    return chosen


def _strength(children: DataFrame) -> DataFrame:
    """One row: the prior strength by moments, from children (n, k, mean of their parent)."""
    n, k, mean = F.col("n"), F.col("k"), F.col("parent_mean")
    observed = F.sum((k - n * mean) * (k - n * mean))
    chance = F.sum(n * mean * (1 - mean))
    excess = F.sum(n * (n - 1) * mean * (1 - mean))
    # E[(k - n mean)^2] = n mean (1 - mean) (1 + (n - 1) rho), and strength = 1 / rho - 1.
    rho = F.try_divide(observed - chance, excess)
    # Nothing to tell it from: the weakest prior. No spread beyond chance: the strongest.
    strength = F.when(rho.isNull(), LEAST_STRENGTH).when(rho > 0, 1 / rho - 1).otherwise(MOST_STRENGTH)
    bounded = F.least(F.greatest(strength, F.lit(LEAST_STRENGTH)), F.lit(MOST_STRENGTH))
    return children.agg(bounded.alias("strength"))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """Per host of ``outcomes`` (host, good, labelled): alpha and beta of its posterior.

    ``outcomes`` has one row per page; ``labelled`` is 1 where the outcome is known and ``good`` is then 0
    or 1. Sums are taken once per host; the levels above are sums over hosts.
    """
    hosts = stored(
        outcomes.groupBy("host")
        .agg(F.sum("labelled").alias("n"), F.sum("good").alias("k"))
        .withColumn("domain", registered_domain(F.col("host")))
        .withColumn("suffix", suffix(F.col("host"))),
        "hosts",
    )
    total = hosts.agg(
        ((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("parent_mean")
    )
    level = total
    keys: list[str] = []
    for name in ("suffix", "domain"):
        keys.append(name)
        counted = hosts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
        children = counted.join(level, keys[:-1]) if keys[:-1] else counted.withColumn(
            "parent_mean", _scalar(total, "parent_mean")
        )
        prior = _scalar(_strength(children), "strength")
        mean = (F.col("k") + prior * F.col("parent_mean")) / (F.col("n") + prior)
        level = stored(children.select(*keys, mean.alias("parent_mean")), name)
    children = hosts.join(level, keys)
    prior = _scalar(_strength(children), "strength")
    return children.select(
        "host",
        (F.col("k") + prior * F.col("parent_mean")).alias("alpha"),
        (F.col("n") - F.col("k") + prior * (1 - F.col("parent_mean"))).alias("beta"),
    )


def _scalar(one_row: DataFrame, column: str) -> Column:
    return one_row.select(column).scalar()


def upper_bound(alpha: Column, beta: Column, deviations: float = BOUND_DEVIATIONS) -> Column:
    n = alpha + beta
    mean = alpha / n
    return mean + F.lit(deviations) * F.sqrt(mean * (1 - mean) / (n + 1))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    least_good_rate: float = LEAST_GOOD_RATE,
) -> DataFrame:
    """Per page: page_id, host, path, rule, verdict. ``outcomes`` has (page_id, good), good 0 or 1."""
    parsed = pages.select(F.col(page_id).alias("page_id"), url_host(url).alias("host"), url_path(url).alias("path"))
    # One row per labelled page, so that no page is doubled.
    known = outcomes.filter(F.col("good").isNotNull() & F.col("page_id").isNotNull())
    known = known.groupBy("page_id").agg(F.sum("good").alias("good"), F.count("good").alias("labelled"))
    labelled = parsed.join(known, "page_id", "left").fillna(0, ["good", "labelled"])
    reputation = stored(
        host_reputation(labelled).select(
            "host", (upper_bound(F.col("alpha"), F.col("beta")) >= least_good_rate).alias("good_host")
        ),
        "reputation",
    )
    judged = parsed.join(reputation, "host", "left").withColumn(
        "chosen", matching_rule(F.col("host"), F.col("path"), rules)
    )
    by_host = F.when(F.col("good_host"), "allow").otherwise("block")
    return judged.select(
        F.col("page_id").alias(page_id), "host", "path", F.col("chosen.rule").alias("rule"),
        F.coalesce(F.col("chosen.rule_verdict"), by_host).alias("verdict"),
    )


def page_outcomes(labels: DataFrame) -> DataFrame:
    """Labelled outcomes for :func:`judge_urls`: a page is good when its label says quality and not toxic.
    The label table numbers what it covers by ``doc_id``."""
    good = (F.col("quality") == 1) & (F.col("toxic") == 0)
    return labels.select(F.col("doc_id").alias("page_id"), good.cast("bigint").alias("good"))
