"""Host reputation by empirical Bayes, with DataFrame operations only.

Outcomes of labelled pages are counted by host, registered domain and suffix. Each level's beta prior
is centred on the posterior mean of the level above; its weight comes from the spread between the level's
groups (method of moments), so levels that differ little borrow much. A page without a rule is judged by
an upper bound of its host's posterior share of bad pages. A host that is an IP address is a domain of its own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardlens.llm.common import written

#: (action, host, path): fixed values. The longest rule that fits a page decides.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: Suffixes of two labels below which names are registered; others have one label. ``judge`` takes a table instead.
SUFFIXES = ("co.uk", "org.uk", "com.au", "co.jp", "com.br")
#: Host names that are addresses, and what stands for their suffix; no label has brackets.
ADDRESS = r"^(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|\[.*\])$"
NO_SUFFIX = "[ip]"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Least and largest share of the variance that lies between the groups of a level.
SPREAD = (1e-4, 0.9)


def host_and_path(url: Column) -> tuple[Column, Column]:
    rest = F.when(F.instr(url, "://") > 0, F.substring_index(url, "://", 1))
    rest = F.substring(url, F.length(rest) + 4, F.length(url))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _name(host: Column) -> Column:
    """The host without user, port and a last dot."""
    return F.regexp_replace(F.regexp_replace(host, r"^.*@|:[0-9]*$", ""), r"\.$", "")


def domain_and_suffix(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and public suffix; user, port and a last dot don't count. An address is its own domain."""
    name = _name(host)
    last = lambda n: F.substring_index(name, ".", -n)
    two, address = last(2).isin(*suffixes), name.rlike(ADDRESS)
    return (
        F.when(address, name).when(two, last(3)).otherwise(last(2)),
        F.when(address, NO_SUFFIX).when(two, last(2)).otherwise(last(1)),
    )


def with_domains(hosts: DataFrame, suffixes: DataFrame | None = None) -> DataFrame:
    """``hosts`` (distinct in host, n, bad) with domain and suffix, by the longest of ``suffixes`` (suffix) that a host ends in.

    Without a table SUFFIXES holds. A host that ends in no listed suffix has its last label as suffix; a
    suffix alone is its own domain. Listed suffixes are plain names, so wildcards must be written out.
    """
    if suffixes is None:
        domain, suffix = domain_and_suffix(F.col("host"))
        return hosts.select("host", domain.alias("domain"), suffix.alias("suffix"), "n", "bad")
    name = _name(F.col("host"))
    labels = F.split(name, r"\.")
    tail = lambda at: F.array_join(F.slice(labels, at, F.size(labels)), ".")
    listed = suffixes.select(F.translate("suffix", UPPER, LOWER).alias("tail")).filter("tail <> ''").distinct().withColumn("hit", F.lit(True))
    places = F.sequence(F.lit(1), F.size(labels))
    tails = hosts.select("host", "n", "bad", F.explode(F.transform(places, lambda at: F.struct(at.alias("at"), tail(at).alias("tail")))).alias("t"))
    found = (
        tails.select("host", "n", "bad", "t.*")
        .join(listed, "tail", "left")
        .groupBy("host", "n", "bad")
        .agg(F.min(F.when(F.col("hit"), F.col("at"))).alias("at"))
        .withColumn("at", F.coalesce("at", F.size(labels)))
    )
    address = name.rlike(ADDRESS)
    return found.select(
        "host",
        F.when(address, name).otherwise(tail(F.greatest(F.col("at") - 1, F.lit(1)))).alias("domain"),
        F.when(address, NO_SUFFIX).otherwise(tail(F.col("at"))).alias("suffix"),
        "n",
        "bad",
    )


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule as host and path, action) of the longest rule that fits; null without one."""
    rule = action = F.lit(None).cast("string")
    for act, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        rule, action = F.when(fits, h + p).otherwise(rule), F.when(fits, act).otherwise(action)
    return rule, action


def _shrunk(groups: DataFrame, parent: Column) -> Column:
    """Posterior mean of ``bad`` of ``n`` around ``parent``, and the weight of the prior, for this level.

    One aggregate over the level's groups gives the share of variance between them.
    """
    v, share = parent * (1 - parent), F.col("bad") / F.col("n")
    spread, within, room = (
        groups.filter("n > 0")
        .agg(F.sum(F.col("n") * (share - parent) * (share - parent)), F.sum(v), F.sum(v * (F.col("n") - 1)))
        .first()
    )
    rho = (spread - within) / room if room else SPREAD[0]
    rho = min(max(rho, SPREAD[0]), SPREAD[1])
    return F.lit(1 / rho - 1)


def host_posteriors(counts: DataFrame) -> DataFrame:
    """counts: host, domain, suffix, n, bad. Gives host, mean, weight (of the posterior beta)."""
    suffix = counts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = counts.agg(F.sum("n"), F.sum("bad")).first()
    top = F.lit(((total[1] or 0) + 0.5) / ((total[0] or 0) + 1.0))
    m = _shrunk(suffix, top)
    suffix = suffix.select("suffix", ((m * top + F.col("bad")) / (m + F.col("n"))).alias("above"))
    domain = counts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).join(suffix, "suffix")
    m = _shrunk(domain, F.col("above"))
    domain = domain.select("domain", "suffix", ((m * F.col("above") + F.col("bad")) / (m + F.col("n"))).alias("above"))
    host = counts.join(domain, ["suffix", "domain"])
    m = _shrunk(host, F.col("above"))
    return host.select(
        "host",
        ((m * F.col("above") + F.col("bad")) / (m + F.col("n"))).alias("mean"),
        (m + F.col("n")).alias("weight"),
    )


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    page_id: str = "page_id",
    url: str = "url",
    rules=RULES,
    max_bad: float = 0.5,
    z: float = 1.6448536269514722,
    suffixes: DataFrame | None = None,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, bad_share, bad_bound.

    outcomes: page_id, bad (0 or 1), for some pages. bad_bound is mean + z standard deviations of the
    host's posterior; without a rule a page is blocked if it lies above ``max_bad``. Urls that are null or
    without ``://`` have an empty host, which is judged like any other. Pages with several outcomes count as
    bad if one is; null outcomes and ids don't count; repeated pages count each. Without any outcome the
    prior alone decides. An empty table gives no rows; other columns don't matter. suffixes: a table of
    public suffixes (suffix) instead of the few built in.
    """
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(page_id).alias("page_id"), host.alias("host"), path.alias("path"))
    known = outcomes.filter("bad IS NOT NULL").groupBy(F.col("page_id").alias("labelled")).agg(F.max("bad").alias("bad"))
    hosts = (
        rows.join(known, rows.page_id == known.labelled, "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    counts = written(with_domains(hosts, suffixes))
    rule, action = rule_of(F.col("host"), F.col("path"), rules)
    bound = F.col("mean") + z * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("weight") + 1))
    return (
        rows.join(host_posteriors(counts), "host")
        .select(
            "page_id",
            "host",
            "path",
            rule.alias("rule"),
            F.coalesce(action, F.when(bound > max_bad, "block").otherwise("allow")).alias("verdict"),
            F.col("mean").alias("bad_share"),
            bound.alias("bad_bound"),
        )
    )
