"""URL filter: path rules, and an empirical-Bayes reputation of hosts where no rule fits.

Labelled page outcomes are counted per host and shrunk step by step: the share
of bad pages of a suffix towards the overall share, of a registered domain
towards its suffix, of a host towards its domain. How strongly each level is
shrunk is learned from all labelled pages: the over-dispersion of a level's
counts about its parents' shares gives the weight of the beta prior. A host is
blocked if the lower posterior bound of its bad share is above a limit.
Everything is built-in column functions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.sources.sinks import materialise

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SUFFIXES = (  # of several labels, under which names are registered: configuration, common ones only
    "co.uk", "org.uk", "ac.uk", "gov.uk", "me.uk", "ltd.uk", "com.au", "net.au", "org.au", "edu.au", "gov.au", "co.nz", "org.nz",
    "co.jp", "or.jp", "ne.jp", "ac.jp", "go.jp", "co.kr", "or.kr", "com.cn", "net.cn", "org.cn", "com.tw", "com.hk", "com.sg",
    "com.my", "co.th", "co.id", "co.in", "com.br", "org.br", "com.ar", "com.mx", "com.co", "com.tr", "co.il", "co.za", "com.ua",
)


def ascii_lower(value: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(value, UPPER, UPPER.lower())


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, lower-cased; empty without ``://`` or for null."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty without ``://`` or for null."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def first_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest fitting rule and its action; both null if none fits. Of equally long rules the smaller text wins.

    ``rules`` are pairs such as ``("block", "example.org/es/")``: configuration,
    written into the plan. A rule fits its host and subdomains if the path starts
    with the rule's.
    """
    rule, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for act, text in sorted(rules, key=lambda r: (len(r[1]), [-ord(c) for c in r[1]])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        rule, action = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(act)).otherwise(action)
    return rule, action


def domain_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """Registered domain: the suffix and the label before it, if there is one."""
    return _last_labels(host, suffixes, 1)


def suffix_of(host: Column, suffixes: Sequence[str] = SUFFIXES) -> Column:
    """The longest of ``suffixes`` that the host ends with or is, else its last label."""
    return _last_labels(host, suffixes, 0)


def _last_labels(host: Column, suffixes: Sequence[str], more: int) -> Column:
    found = F.substring_index(host, ".", -1 - more)
    for n in sorted({s.count(".") + 1 for s in suffixes}):
        fits = F.substring_index(host, ".", -n).isin([s for s in suffixes if s.count(".") + 1 == n])
        found = F.when(fits, F.substring_index(host, ".", -n - more)).otherwise(found)
    return found


def _weight(groups: DataFrame) -> float:
    """Weight of the beta prior: rows have ``n``, ``bad`` and the parent's share ``mu``.

    Pearson's statistic of the groups about their parents is, under a
    beta-binomial law, the number of groups plus (pages - groups) times the
    over-dispersion; its inverse less one is the weight.
    """
    seen = groups.filter("n > 0")
    over = (F.col("bad") - F.col("n") * F.col("mu")) ** 2 / (F.col("n") * F.col("mu") * (1 - F.col("mu")))
    spread = (F.sum(over) - F.count("n")) / F.greatest(F.sum("n") - F.count("n"), F.lit(1))
    spread = F.least(F.greatest(F.coalesce(spread, F.lit(0.001)), F.lit(0.001)), F.lit(0.5))
    return seen.agg((1 / spread - 1).alias("w")).first()["w"]


def reputations(outcomes: DataFrame, z: float = 1.645, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Per host: ``n`` labelled pages, ``n_bad``, posterior mean ``bad_share`` and its lower bound ``bad_bound``.

    ``outcomes`` has ``host`` and ``bad`` (0, 1 or null for a page without label),
    a row for each page. Hosts without labelled pages take the posterior of
    their domain as prior. With no labels at all there is no bound, and no host is blocked.
    ``suffixes`` are those of several labels. Hosts are counted once, into a table;
    the driver takes five numbers of it.
    """
    hosts = materialise(outcomes.groupBy("host").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("bad")
    ).withColumns({"domain": domain_of(F.col("host"), suffixes), "suffix": suffix_of(F.col("host"), suffixes)}))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    tops = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    seen = tops.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    evidence = F.lit(seen["n"])
    tops = tops.withColumn("mu", F.lit((seen["bad"] + 1.0) / (seen["n"] + 2.0)))
    tops = tops.withColumn("w", F.lit(_weight(tops)))
    domains = domains.join(tops.select("suffix", _share().alias("mu")), "suffix")
    domains = domains.withColumn("w", F.lit(_weight(domains)))
    hosts = hosts.join(domains.select("domain", _share().alias("mu")), "domain")
    hosts = hosts.withColumn("w", F.lit(_weight(hosts)))
    total = F.col("n") + F.col("w")
    share = _share()
    return hosts.select(
        "host", "n", F.col("bad").alias("n_bad"), share.alias("bad_share"),
        F.when(evidence > 0, share - z * F.sqrt(share * (1 - share) / (total + 1))).alias("bad_bound"),
    )


def _share() -> Column:
    return (F.col("bad") + F.col("w") * F.col("mu")) / (F.col("n") + F.col("w"))


def judge(
    pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]], id: str = "page_id", url: str = "url",
    max_bad: float = 0.25, z: float = 1.645, suffixes: Sequence[str] = SUFFIXES,
) -> DataFrame:
    """Per row of ``pages``: ``id``, ``host``, ``path``, ``rule`` and ``verdict`` (allow or block), ``bad_bound``.

    ``labels`` has the columns ``id`` and ``bad`` (0 or 1); of repeated labels the
    larger counts, null ones and ids do not. Repeated page rows count each. Null
    urls and urls without ``://`` have an empty host, which is judged like any
    other. Other columns are not read. An empty table gives no rows. ``suffixes`` are
    those of several labels under which names are registered.
    """
    parsed = pages.select(
        F.col(id).alias("_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")
    )
    known = labels.groupBy(F.col("id").alias("_id")).agg(F.max("bad").alias("bad"))
    found = reputations(parsed.select("_id", "host").join(known, "_id", "left"), z, suffixes).select("host", "bad_bound")
    rule, action = first_rule(F.col("host"), F.col("path"), rules)
    by_method = F.when(F.col("bad_bound") > max_bad, "block").otherwise("allow")
    return parsed.join(found, "host").select(
        F.col("_id").alias(id), "host", "path", rule.alias("rule"), F.coalesce(action, by_method).alias("verdict"),
        "bad_bound",
    )
