"""URL filter by rules and by the empirical-Bayes reputation of hosts.

Only DataFrame functions are used.  Labelled page outcomes (1 good, 0 bad) are
counted per host.  A host's rate of good pages is shrunk by a beta prior whose
mean is that of its registered domain, which is itself shrunk towards its
suffix, and that towards all pages.  The strength of each prior comes from the
data: the method of moments on the overdispersion of the children of one level.
A host is blocked if the lower bound of its posterior is below a threshold.

Edge cases: a null URL or one without ``://`` has an empty host and an empty
path; all such pages share the reputation of the empty host.  Null outcomes are
left out; repeated pages and repeated labels each count.  Without any outcome
every host has the prior mean ``default_rate``.  An empty table gives no rows.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storelens.llm.common import checked_join, stored

# Suffixes of two labels under which domains are registered.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.uk", "com.au", "com.br", "org.uk")

Z = 1.645
LEAST_RATE = 0.5
DEFAULT_RATE = 0.5
WEAKEST, STRONGEST = 2.0, 10_000.0

Rule = tuple[str, str, str]


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def registered_domain(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def matching_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """The longest rule (action, host, path) that fits, and its action; both null if none fits.

    A rule fits its host and all subdomains.  Of rules equally long the first one counts.
    """
    name, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    # The longest is asked first, so that it ends up outermost.
    for verdict, rule_host, rule_path in sorted(reversed(rules), key=lambda rule: len(rule[1] + rule[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        action = F.when(fits, F.lit(verdict)).otherwise(action)
    return name, action


def _counts(df: DataFrame, level: str) -> DataFrame:
    return df.groupBy(level).agg(F.sum("n").alias(f"n_{level}"), F.sum("good").alias(f"good_{level}"))


def _strength(children: DataFrame, child: str, parent: str) -> DataFrame:
    """One row: the prior strength that the spread of the children around their parents implies."""
    n, total = F.col(f"n_{child}"), F.col(f"n_{parent}")
    mean = F.col(f"good_{parent}") / total
    noise = mean * (1 - mean)
    share = 1 - n / total
    over = children.agg(
        F.sum(n * F.pow(F.col(f"good_{child}") / n - mean, 2.0)).alias("seen"),
        F.sum(noise * share).alias("expected"),
        F.sum(noise * share * (n - 1)).alias("scale"),
    )
    rho = F.when(F.col("scale") > 0, (F.col("seen") - F.col("expected")) / F.col("scale"))
    strength = F.when(rho > 0, F.greatest(F.lit(WEAKEST), F.least(F.lit(STRONGEST), (1 - rho) / rho)))
    return over.select(F.coalesce(strength, F.lit(STRONGEST)).alias(f"strength_{child}"))


def host_reputation(outcomes: DataFrame, *, z: float = Z) -> DataFrame:
    """One row per host with outcomes: counts, posterior mean and lower bound, and the same for its domain, suffix and all.

    ``outcomes`` has host, n and good (numbers of labelled and of good pages).
    """
    hosts = outcomes.where(F.col("n") > 0).groupBy("host").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    hosts = stored(hosts.withColumns({"domain": registered_domain(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    named = hosts.withColumnsRenamed({"n": "n_host", "good": "good_host"})
    domains = _counts(hosts, "domain")
    domain_suffix = hosts.select("domain", "suffix").distinct()
    suffixes = _counts(hosts, "suffix")
    everything = hosts.agg(F.sum("n").alias("n_all"), F.sum("good").alias("good_all"))

    by_suffix = suffixes.crossJoin(F.broadcast(everything))
    by_domain = domains.join(domain_suffix, "domain").join(suffixes, "suffix")
    by_host = named.join(domains, "domain")
    strengths = (
        _strength(by_suffix, "suffix", "all")
        .crossJoin(F.broadcast(_strength(by_domain, "domain", "suffix")))
        .crossJoin(F.broadcast(_strength(by_host, "host", "domain")))
    )

    def shrunk(level: str, prior: Column) -> Column:
        strength = F.col(f"strength_{level}")
        return (F.col(f"good_{level}") + strength * prior) / (F.col(f"n_{level}") + strength)

    # Every one-row side is an aggregate without keys.
    rows = by_host.join(suffixes, "suffix").crossJoin(F.broadcast(everything)).crossJoin(F.broadcast(strengths))
    rows = rows.withColumn("rate_suffix", shrunk("suffix", F.col("good_all") / F.col("n_all")))
    rows = rows.withColumn("rate_domain", shrunk("domain", F.col("rate_suffix")))
    alpha = F.col("good_host") + F.col("strength_host") * F.col("rate_domain")
    total = F.col("n_host") + F.col("strength_host")
    return rows.select(
        "host", "domain", "suffix", "n_host", "good_host", "n_domain", "n_suffix", "rate_suffix", "rate_domain",
        "strength_host", (F.col("good_all") / F.col("n_all")).alias("rate_all"),
        (alpha / total).alias("rate"),
        lower_bound(alpha, total, z).alias("bound"),
    )


def lower_bound(alpha: Column, total: Column, z: float) -> Column:
    """Lower bound of a beta distribution (alpha, total - alpha) by its mean and deviation."""
    mean = alpha / total
    return mean - z * F.sqrt(mean * (1 - mean) / (total + 1))


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[Rule],
    *,
    url: str = "url",
    z: float = Z,
    least_rate: float = LEAST_RATE,
) -> DataFrame:
    """Add host, path, rule and verdict to every page.

    A rule decides where one fits, otherwise the reputation: a page is blocked if
    its host's posterior bound is below ``least_rate``.  A host without outcomes
    takes the prior of its domain, else of its suffix, else of all pages.
    ``outcomes`` has host, n and good.  Columns of ``pages`` with one of the added
    names are replaced.
    """
    known = stored(host_reputation(outcomes, z=z), "reputation")
    strength = F.max("strength_host").alias("strength_host")
    levels = {
        "host": known.select("host", F.col("bound").alias("_by_host")),
        "domain": known.groupBy("domain").agg(F.max("rate_domain").alias("rate"), strength),
        "suffix": known.groupBy("suffix").agg(F.max("rate_suffix").alias("rate"), strength),
    }
    for level in ("domain", "suffix"):
        bound = lower_bound(F.col("rate") * F.col("strength_host"), F.col("strength_host"), z)
        levels[level] = levels[level].select(level, bound.alias(f"_by_{level}"))
    overall = known.agg(F.max("rate_all").alias("rate"), strength).select(
        lower_bound(
            F.coalesce("rate", F.lit(DEFAULT_RATE)) * F.coalesce("strength_host", F.lit(STRONGEST)),
            F.coalesce("strength_host", F.lit(STRONGEST)), z,
        ).alias("_by_all")
    )
    host, path = host_of(F.col(f"`{url}`")), path_of(F.col(f"`{url}`"))
    # The pages' own columns are held in one, so that no name of theirs meets one from here.
    own = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    judged = pages.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("row"), host.alias("host"), path.alias("path"))
    judged = judged.withColumns({"_host": F.col("host"), "_domain": registered_domain(F.col("host")), "_suffix": suffix_of(F.col("host"))})
    for level, bounds in levels.items():
        judged = checked_join(judged, stored(bounds, level).withColumnRenamed(level, f"_{level}"), f"_{level}", "left")
    judged = judged.crossJoin(F.broadcast(overall))
    name, action = matching_rule(F.col("host"), F.col("path"), rules)
    bound = F.coalesce("_by_host", "_by_domain", "_by_suffix", "_by_all")
    by_method = F.when(bound < least_rate, "block").otherwise("allow")
    return judged.select("row.*", "host", "path", name.alias("rule"), F.coalesce(action, by_method).alias("verdict"))
