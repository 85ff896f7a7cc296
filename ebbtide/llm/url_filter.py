"""URL rules and host reputation, with DataFrame functions only.

Reputation is empirical Bayes: labelled outcomes of pages are counted by host. The share of bad pages of a suffix is shrunk to the
share of all pages, that of a registered domain to its suffix, and that of a host to its domain. How strongly is a beta-binomial prior of
the level, fitted by moments to the spread between its members beyond chance. A host is blocked where the lower bound of
its posterior share exceeds a limit, so a host with few labels follows its domain.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.common import ascii_lower, join_hot, packed, stored, unpacked
from ebbtide.llm.public_suffixes import SUFFIXES

ALLOW, BLOCK = "allow", "block"
#: Fixed values of the contract: (host, start of the path, verdict).
RULES = (
    ("org", "/", ALLOW), ("example.org", "/es/", BLOCK), ("example.org", "/en/1", BLOCK), ("com", "/fr/", ALLOW),
    ("com", "/de/", BLOCK),
)
BAD_SHARE = 0.5
Z = 1.645
LEAST_SPREAD, MOST_SPREAD = 1e-4, 0.9


def host_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + 4)
    host = ascii_lower(F.regexp_extract(after, r"^[^/?#]*", 0))
    return F.when(F.instr(url, "://") > 0, host).otherwise(F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.substring_index(url, "://", 1)
    after = F.substr(url, F.length(rest) + 4)
    path = F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1)
    return F.when(F.instr(url, "://") > 0, path).otherwise(F.lit(""))


def _longest_first(rules: tuple) -> list:
    return sorted(rules, key=lambda r: (-len(r[0] + r[1]), r))


def _fits(rule: tuple, host: Column, path: Column) -> Column:
    return ((host == rule[0]) | host.endswith(f".{rule[0]}")) & path.startswith(rule[1])


def rule_column(rules: tuple, host: Column, path: Column, of: int | None = None) -> Column:
    """The name of the longest rule that fits, or what it says; null without one. Equally long rules: by name."""
    out = F.lit(None).cast("string")
    for rule in reversed(_longest_first(rules)):
        out = F.when(_fits(rule, host, path), F.lit(rule[0] + rule[1] if of is None else rule[of])).otherwise(out)
    return out


def site_of(host: Column) -> Column:
    """The host without user part, port and dots at the end."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", ""), r"\.+$", "")


def _is_address(site: Column) -> Column:
    return site.rlike(r"^(\[.*\]|[0-9]{1,3}(\.[0-9]{1,3}){3})$")


def _labels(site: Column) -> Column:
    """Labels of the longest public suffix in the table; one where none fits."""
    out = F.lit(1)
    for n in sorted({s.count(".") + 1 for s in SUFFIXES}):
        listed = [s for s in SUFFIXES if s.count(".") + 1 == n]
        out = F.when(F.substring_index(site, ".", -n).isin(listed), n).otherwise(out)
    return out


def _last(site: Column, n: Column) -> Column:
    parts = F.split(site, r"\.")
    return F.array_join(F.slice(parts, F.greatest(F.lit(1), F.size(parts) - n + 1), n), ".")


def suffix_of(host: Column) -> Column:
    """All addresses share one suffix."""
    site = site_of(host)
    return F.when(_is_address(site), F.lit("(address)")).otherwise(_last(site, _labels(site)))


def domain_of(host: Column) -> Column:
    """One label more than the suffix; an address is a domain of its own."""
    site = site_of(host)
    return F.when(_is_address(site), site).otherwise(_last(site, _labels(site) + 1))


def strength(counts: DataFrame, bad: str = "bad", n: str = "labelled") -> DataFrame:
    """One row: the concentration of the beta prior that explains the spread between the rows of a level."""
    sums = counts.where(F.col(n) > 0).agg(
        F.sum(bad).alias("k"), F.sum(n).alias("n"), F.count(F.lit(1)).alias("c"),
        F.sum(F.col(n) * F.col(n) * F.lit(1.0)).alias("nn"), F.sum(F.col(bad) * F.col(bad) / F.col(n)).alias("kkn"),
    )
    p = F.col("k") / F.col("n")
    spread = (F.col("kkn") - F.col("k") * p) / (p * (1 - p)) - (F.col("c") - 1)
    room = F.col("n") - F.col("nn") / F.col("n") - (F.col("c") - 1)
    rho = F.when((room > 0) & (p > 0) & (p < 1), spread / room).otherwise(F.lit(0.0))
    bounded = F.greatest(F.lit(LEAST_SPREAD), F.least(F.lit(MOST_SPREAD), F.coalesce(rho, F.lit(0.0))))
    return sums.select(((1 - bounded) / bounded).alias("strength"))


def host_reputation(outcomes: DataFrame, bad_share: float = BAD_SHARE, z: float = Z) -> DataFrame:
    """host, pages, labelled, bad, mean, bound, verdict of each host. outcomes: rows (host, bad), bad is 0, 1 or null.

    Null outcomes count as unlabelled. Without any label the share is a half and nothing is blocked.
    """
    hosts = stored(
        outcomes.groupBy("host").agg(
            F.count(F.lit(1)).alias("pages"), F.count("bad").alias("labelled"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad")
        ).withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
    )
    sums = [F.sum("labelled").alias("labelled"), F.sum("bad").alias("bad")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*sums)
    every = hosts.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("k"), F.coalesce(F.sum("labelled"), F.lit(0)).alias("n")).first()
    mean = (every["k"] + 1) / (every["n"] + 2)
    s_suffix, s_domain, s_host = (strength(x).first()["strength"] for x in (suffixes, domains, hosts))
    shrunk = lambda k, n, prior, s: (F.col(k) + F.lit(s) * prior) / (F.col(n) + F.lit(s))
    suffix_mean = suffixes.select("suffix", shrunk("bad", "labelled", F.lit(mean), s_suffix).alias("_suffix_mean"))
    # A suffix has very many domains, and a domain that rents out names very many hosts.
    of_suffix = stored(suffix_mean.join(domains.groupBy("suffix").agg(F.count(F.lit(1)).alias("_domains")), "suffix"))
    spread = lambda c: F.concat(F.lit("#"), F.col(c))
    rated = join_hot(domains, of_suffix, "suffix", "_domains", spread("domain"))
    domain_mean = rated.select("domain", shrunk("bad", "labelled", F.col("_suffix_mean"), s_domain).alias("_domain_mean"))
    of_domain = stored(domain_mean.join(hosts.groupBy("domain").agg(F.count(F.lit(1)).alias("_hosts")), "domain"))
    a = F.col("bad") + F.lit(s_host) * F.col("_domain_mean")
    b = F.col("labelled") - F.col("bad") + F.lit(s_host) * (1 - F.col("_domain_mean"))
    deviation = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    known = join_hot(hosts, of_domain, "domain", "_hosts", spread("host")).withColumn("mean", a / (a + b)).withColumn("bound", F.col("mean") - F.lit(z) * deviation)
    return known.select(
        "host", "pages", "labelled", "bad", "mean", "bound", F.when(F.col("bound") > bad_share, BLOCK).otherwise(ALLOW).alias("verdict")
    )


def judged_urls(pages: DataFrame, outcomes: DataFrame, rules: tuple = RULES, bad_share: float = BAD_SHARE, z: float = Z) -> DataFrame:
    """The columns of ``pages`` and host, path, rule, verdict.

    outcomes: (page_id, bad), at most one row counts per page (the worst). A null url and one without ``://`` have an empty host and path; such
    pages together are one host. The longest rule that fits decides, else the reputation of the host. Repeated pages are judged each; columns
    of ``pages`` with the four names are replaced.
    """
    needed = ["page_id", "url"]
    placed = packed(pages, needed).withColumn("host", F.coalesce(host_of(F.col("url")), F.lit(""))).withColumn("path", F.coalesce(path_of(F.col("url")), F.lit("")))
    marked = outcomes.groupBy("page_id").agg(F.max("bad").alias("bad"))
    seen = placed.select("page_id", "host").join(marked, "page_id", "left").select("host", "bad")
    reputation = stored(host_reputation(seen, bad_share, z).select("host", "pages", F.col("verdict").alias("_method")))
    spread = F.concat(F.lit("#"), F.coalesce(F.col("page_id").cast("string"), F.lit("")))
    # A hot host's rows keep their place; the others meet their host.
    found = join_hot(placed, reputation.withColumnRenamed("pages", "_pages"), "host", "_pages", spread)
    host, path = F.col("host"), F.col("path")
    verdict = F.coalesce(rule_column(rules, host, path, 2), F.col("_method"))
    return unpacked(found, pages, needed, {"host": host, "path": path, "rule": rule_column(rules, host, path), "verdict": verdict})
