"""URL filter: fixed rules first, then the reputation of the host.

A host's share of good pages is estimated by empirical Bayes. Labelled outcomes are
counted by host, registered domain and public suffix; each level's estimate is a
beta-binomial posterior whose prior has the mean of the level above and a strength
estimated from how far the level's groups scatter (method of moments). A host is
blocked if even the upper posterior bound of its good share is below a limit, so
that hosts with few outcomes follow their domain.

Everything is DataFrame functions; the driver sees one row of sums for each level.
Pages are counted by host once, into a table that all levels read, and the join by host is
an ordinary one, which adaptive execution may split at a busy host.

A NULL URL, or one without ``://``, has an empty host and path and is judged like
any host. Repeated pages count each; a page with several outcomes counts as bad if
one is. Pages without id have no outcome. Without outcomes all estimates are the
prior mean 1/2.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renewlens.session import staged

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Policy:
    """``rules``: (host and path, verdict); a host with its path from ``/`` on.

    ``long_suffixes``: public suffixes of several labels, as rules like ``co.uk``, ``*.ck``
    (any one label) and ``!www.ck`` (no suffix, although a rule with a star fits).
    """

    rules: Sequence[tuple[str, str]] = ()
    long_suffixes: Sequence[str] = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")
    least_good: float = 0.5
    deviations: float = 2.0
    strengths: tuple[float, float] = (1.0, 1000.0)  # bounds of a prior's strength


def host(url: Column) -> Column:
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _named(name: Column) -> Column:
    """A host without user, port and final dot."""
    return F.regexp_replace(name, r"^.*@|:[0-9]*$|\.$", "")


def _tail(labels: Column, first: Column) -> Column:
    """The labels from the ``first`` (from 1) on, as a name."""
    return F.array_join(F.slice(labels, first, F.size(labels)), ".")


def _suffix_start(labels: Column, policy: Policy) -> Column:
    """The place of the suffix's first label: the longest rule that fits, exceptions first."""
    kinds: dict[str, list[str]] = {"!": [], "*": [], "": []}
    for rule in policy.long_suffixes:
        kind = rule[0] if rule[0] in "!*" else ""
        kinds[kind].append(rule[2:] if kind == "*" else rule[len(kind) :])
    size = F.size(labels)
    places = F.sequence(F.lit(1), size)

    def first(fits, rules: list[str]) -> Column:
        return F.array_min(F.filter(places, fits)) if rules else F.lit(None).cast("int")

    exception = first(lambda i: _tail(labels, i).isin(kinds["!"]), kinds["!"])
    # A star stands for one label: the rest of the rule begins a label later.
    starred = first(lambda i: (i < size) & _tail(labels, i + 1).isin(kinds["*"]), kinds["*"])
    plain = first(lambda i: _tail(labels, i).isin(kinds[""]), kinds[""])
    # Without a rule the last label is the suffix. least() leaves out NULL.
    return F.coalesce(exception + 1, F.least(starred, plain, size))


def suffix(name: Column, policy: Policy) -> Column:
    labels = F.split(_named(name), r"\.")
    return _tail(labels, _suffix_start(labels, policy))


def registered_domain(name: Column, policy: Policy) -> Column:
    """One label more than the suffix; the whole host if it has no more, or is an address."""
    plain = _named(name)
    labels = F.split(plain, r"\.")
    start = F.greatest(_suffix_start(labels, policy) - 1, F.lit(1))
    return F.when(plain.rlike(r"^[0-9.]+$"), plain).otherwise(_tail(labels, start))


def matched_rule(name: Column, route: Column, policy: Policy) -> Column:
    """The longest rule that fits, or NULL."""
    found = F.lit(None).cast("string")
    for rule, _ in sorted(policy.rules, key=lambda r: (len(r[0]), r[0])):
        rule_host, _, rest = rule.partition("/")
        fits = (name == rule_host) | name.endswith("." + rule_host)
        found = F.when(fits & route.startswith("/" + rest), rule).otherwise(found)
    return found


def _strength(groups: DataFrame, policy: Policy) -> float:
    """Prior strength from groups with ``n``, ``good`` and their parent's ``mean``.

    A group of n outcomes scatters around its parent's mean m with m (1 - m)
    (1 + (n - 1) r) / n, where the strength is 1 / r - 1.
    """
    excess = F.pow(F.col("good") - F.col("n") * F.col("mean"), 2) / (
        F.col("n") * F.col("mean") * (1 - F.col("mean"))
    )
    row = groups.where("n > 0").agg(
        F.sum(excess).alias("s"), F.count("*").alias("groups"), F.sum("n").alias("n")
    ).first()
    low, high = policy.strengths
    if row["s"] is None or row["n"] == row["groups"]:
        return high
    spread = (row["s"] - row["groups"]) / (row["n"] - row["groups"])
    return high if spread <= 0 else min(high, max(low, 1 / min(spread, 1.0) - 1))


def _posterior(strength: float) -> Column:
    return (F.col("good") + F.lit(strength) * F.col("mean")) / (F.col("n") + F.lit(strength))


def host_reputation(visits: DataFrame, policy: Policy) -> DataFrame:
    """(host, n, good, good_share, upper_bound) from rows of (host, good or NULL)."""
    hosts = visits.groupBy("host").agg(
        F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")
    )
    hosts = hosts.select(
        "*",
        registered_domain(F.col("host"), policy).alias("domain"),
        suffix(F.col("host"), policy).alias("suffix"),
    )
    # Every level and its sums are read from here; pages and outcomes are read once.
    hosts = staged(hosts, "hosts")
    sums = (F.sum("n").alias("n"), F.sum("good").alias("good"))
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    total = suffixes.agg(*sums).first()
    mean = ((total["good"] or 0) + 1.0) / ((total["n"] or 0) + 2.0)

    suffixes = suffixes.withColumn("mean", F.lit(mean))
    above = suffixes.select("suffix", _posterior(_strength(suffixes, policy)).alias("mean"))
    domains = domains.join(above, "suffix")
    above = domains.select("domain", "suffix", _posterior(_strength(domains, policy)).alias("mean"))
    hosts = hosts.join(above, ["domain", "suffix"])
    strength = _strength(hosts, policy)
    share = _posterior(strength)
    deviation = F.sqrt(share * (1 - share) / (F.col("n") + F.lit(strength) + 1))
    return hosts.select(
        "host",
        "n",
        "good",
        share.alias("good_share"),
        (share + F.lit(policy.deviations) * deviation).alias("upper_bound"),
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    policy: Policy,
    id_col: str = "page_id",
    url_col: str = "url",
) -> DataFrame:
    """(id, host, path, rule, verdict, n_outcomes, good_share, upper_bound), a row a page.

    ``outcomes`` has (``id_col``, ``good``: 0 or 1).
    """
    url = F.col(url_col)
    rows = pages.select(F.col(id_col).alias("id"), host(url).alias("host"), path(url).alias("path"))
    known = outcomes.groupBy(F.col(id_col).alias("id")).agg(F.min("good").alias("good"))
    visits = rows.select("id", "host").join(known, "id", "left").select("host", "good")
    standing = host_reputation(visits, policy)
    verdicts = dict(policy.rules)
    rule = matched_rule(F.col("host"), F.col("path"), policy)
    verdict = F.when(F.col("upper_bound") < policy.least_good, "block").otherwise("allow")
    for text, decision in verdicts.items():
        verdict = F.when(F.col("rule") == text, decision).otherwise(verdict)
    return (
        rows.withColumn("rule", rule)
        .join(standing, "host")
        .select(
            F.col("id").alias(id_col),
            "host",
            "path",
            "rule",
            verdict.alias("verdict"),
            F.col("n").alias("n_outcomes"),
            F.round("good_share", 6).alias("good_share"),
            F.round("upper_bound", 6).alias("upper_bound"),
        )
    )
