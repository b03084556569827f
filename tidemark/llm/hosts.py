"""URL filter by rules and, where no rule fits, by an empirical-Bayes reputation of the host.

Labelled pages (by default those a rule has judged) give every host a share of good outcomes. Few outcomes say
little, so each share is shrunk: the host's towards its registered domain's, that one's towards its suffix's, and the
suffix's towards the share of all. Each level is a beta-binomial model whose precision is estimated from all its
members by moments. A host is blocked when even the upper bound of its posterior share of good pages is low.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import looked_up, stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Second-level names under which two-letter suffixes register (fixed values).
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")

#: Bounds of the estimated correlation of outcomes in a group, and its value where nothing can be estimated.
LEAST_RHO, MOST_RHO, NO_RHO = 1e-6, 0.999, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null or a text without ``://``."""
    at = F.coalesce(F.instr(url, "://"), F.lit(0))
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    raw = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.length(raw) + 1), "^[^?#]*", 0)
    return F.translate(raw, UPPER, LOWER), path


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The text and the verdict of the longest rule that fits; equally long ones by text, block first."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    longest_last = sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2], r[0] == "block"))
    for kind, rule_host, rule_path in longest_last:
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        text = F.when(fits, F.lit(rule_host + rule_path)).otherwise(text)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return text, verdict


def levels(host: Column, second_level: Sequence[str] = SECOND_LEVEL) -> tuple[Column, Column]:
    """Registered domain and suffix of a host, without user, port and closing dots.

    The suffix is the last name, or the last two where the last has two letters and the one before is a usual
    second level. An address in digits or brackets and a host that is a suffix itself are their own domain.
    """
    bare = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    bare = F.regexp_replace(bare, "[.]+$", "")
    names = F.split(bare, "[.]")
    n = F.size(names)
    last, before = F.element_at(names, -1), F.when(n > 1, F.element_at(names, -2))
    two = (F.length(last) == 2) & before.isin(*second_level)
    taken = F.when(F.coalesce(two, F.lit(False)), 2).otherwise(1)
    address = bare.rlike("^[0-9.]+$") | bare.startswith("[")
    whole = address | (n <= taken)
    suffix = F.when(whole, bare).when(taken == 2, F.substring_index(bare, ".", -2)).otherwise(last)
    three = F.concat_ws(".", F.slice(names, F.greatest(n - taken, F.lit(1)), taken + 1))
    return F.when(whole, bare).otherwise(three), suffix


def correlation(members: DataFrame, parent: Sequence[str]) -> float:
    """How alike outcomes of one member are (the rho of a beta-binomial model), from the spread of members' shares
    about their parent's: observed squares less those of independent outcomes, over what full likeness would add."""
    d = lambda c: F.col(c).cast("double")
    of = members.where("n > 0").groupBy(*parent).agg(
        F.sum(d("n")).alias("N"), F.sum(d("k")).alias("K"), F.sum(d("n") * d("n")).alias("nn"),
        F.sum(d("n") * d("n") * d("n")).alias("nnn"), F.sum(d("k") * d("k")).alias("kk"), F.sum(d("k") * d("n")).alias("kn"),
    )
    p, pq, w = F.expr("K / N"), F.expr("K * (N - K) / (N * N)"), F.expr("nn / (N * N)")
    seen = F.col("kk") - 2 * p * F.col("kn") + p * p * F.col("nn")
    chance = pq * (F.col("N") - F.col("nn") / F.col("N"))
    alike = pq * ((F.col("nn") - F.col("N")) * (1 + w) - 2 * (F.col("nnn") - F.col("nn")) / F.col("N"))
    row = of.agg(F.sum(seen - chance).alias("more"), F.sum(alike).alias("full")).first()
    if not row["full"] or row["full"] < 1e-9:
        return NO_RHO
    return round(min(max(row["more"] / row["full"], LEAST_RHO), MOST_RHO), 9)


def reputation(hosts: DataFrame, z: float = 1.645) -> DataFrame:
    """host, n_pages, share (posterior mean of good outcomes), upper (its bound) of a table host, domain, suffix,
    n_pages, n (labelled pages), k (good ones) with one row per host.

    The bound is ``z`` standard deviations above the mean, 1 at most; the variance is that of the host's Beta posterior
    and, by its weight, that of the shares above it, so a host of an unknown suffix has a wide bound. Without any
    outcome all shares are 1/2. Parents of many members are sent to all tasks, which are few, others meet theirs by hash.
    """
    sums = [F.sum(c).alias(c) for c in ("n_pages", "n", "k")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums, F.count(F.lit(1)).alias("members"))
    suffixes = domains.groupBy("suffix").agg(*sums, F.count(F.lit(1)).alias("members"))
    domains, suffixes = stored(domains, "domains"), stored(suffixes, "suffixes")
    top = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    n = top["n"] or 0
    share = ((top["k"] or 0) + 0.5) / (n + 1.0)
    root = {"above": F.lit(share), "spread": F.lit(share * (1 - share) / (n + 2.0))}

    def shrunk(rho: float) -> tuple[Column, Column]:
        """Posterior mean and variance, what is not known of the parent's share included."""
        precision = F.lit(1 / rho - 1)
        weight = precision + F.col("n")
        mean = (precision * F.col("above") + F.col("k")) / weight
        own = mean * (1 - mean) / (weight + 1)
        return mean.alias("above"), (own + precision * precision / (weight * weight) * F.col("spread")).alias("spread")

    within = correlation(suffixes, [])
    suffixes = suffixes.withColumns(root).select("suffix", "members", *shrunk(within))
    within = correlation(domains, ["suffix"])
    domains = looked_up(domains, ["suffix"], suffixes, "members")
    domains = domains.select("domain", "suffix", "members", *shrunk(within))
    within = correlation(hosts, ["domain", "suffix"])
    known = looked_up(hosts, ["domain", "suffix"], domains, "members")
    mean, variance = shrunk(within)
    known = known.select("host", "n_pages", mean, variance)
    bound = F.least(F.lit(1.0), F.col("above") + z * F.sqrt("spread"))
    return known.select("host", "n_pages", F.col("above").alias("share"), bound.alias("upper"))


def judged(
    pages: DataFrame,
    rules: Sequence[tuple[str, str, str]],
    outcome: Column | None = None,
    least: float = 0.5,
    z: float = 1.645,
    url: str = "url",
    key: str = "page_id",
) -> DataFrame:
    """key, host, path, rule, verdict (allow or block), share and upper (null where a rule has decided).

    ``rules``: (allow or block, host, path); one fits its host and all subdomains if the path starts with its path.
    ``outcome``: true for a good page, false for a bad one, null for an unlabelled one; by default what the rules
    say. A page no rule fits is blocked if the upper bound of its host's posterior share of good pages is below
    ``least``, so a host is blocked on evidence only.

    Null urls and texts without ``://`` have an empty host and path and are judged like any host. Rows that repeat
    are judged each and count each; null keys pass through; an empty table gives an empty one; urls of any length are
    read whole; columns of other names are ignored. Equal shares need no order. Hosts are counted per task before
    the shuffle, and a host with a third of the pages meets its reputation without being gathered.
    """
    host, path = host_and_path(F.col(url))
    cut = pages.select(
        F.col(key), host.alias("host"), path.alias("path"), (F.lit(None).cast("boolean") if outcome is None else outcome).alias("good")
    )
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    cut = cut.withColumns({"rule": rule, "verdict": verdict})
    good = F.col("good") if outcome is not None else F.col("verdict") == "allow"
    counts = cut.groupBy("host").agg(
        F.count(F.lit(1)).alias("n_pages"), F.count(good).alias("n"), F.count_if(good).alias("k")
    )
    domain, suffix = levels(F.col("host"))
    hosts = stored(counts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    known = stored(reputation(hosts, z), "reputation")
    columns = [c for c in cut.columns if c != "good"]
    rows = looked_up(cut.select(*columns), ["host"], known, "n_pages")
    by_host = F.when(F.col("upper") < least, "block").otherwise("allow")
    ruled = F.col("verdict").isNotNull()
    return rows.select(
        key, "host", "path", "rule", F.coalesce("verdict", by_host).alias("verdict"),
        F.when(~ruled, F.col("share")).alias("share"), F.when(~ruled, F.col("upper")).alias("upper"),
    )
