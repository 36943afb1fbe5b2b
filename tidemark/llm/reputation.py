"""URL filtering by rules and by the empirical-Bayes reputation of hosts.

Labelled page outcomes are counted per host and shrunk in steps: a suffix towards all pages, a registered domain towards
its suffix, a host towards its domain. Each step is a beta-binomial prior whose mean is the parent's posterior mean and
whose strength is estimated from how much the children's rates vary beyond chance. A posterior carries the doubt of its
parent's mean, weighted as that mean is. A host is blocked when the lower bound of its posterior bad rate is above a limit. All of it is grouping and equality joins on hosts, never on pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

#: A host is blocked if its bad rate is above BAD_RATE with the confidence of a normal bound of Z deviations.
BAD_RATE, Z = 0.3, 1.645

#: Correlation of outcomes within a child, as estimated, is kept in this range; the strength is 1 / rho - 1.
LEAST_RHO, MOST_RHO = 0.001, 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, with A-Z lowered; '' for no URL."""
    return F.translate(F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*", 0), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; '' for no URL."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _last_labels(host: Column, n: int) -> Column:
    return F.substring_index(F.regexp_replace(host, ":[0-9]*$", ""), ".", -n)


def shrunk(children: DataFrame, key: str) -> DataFrame:
    """(key, mean, doubt) of ``children`` (key, n, bad, prior, prior_doubt): posterior mean and variance.

    The moments of all children give one prior strength for the level. The variance is that of the child around its
    mean, and that of the prior mean as far as the child's mean rests on it.
    """
    variance = F.col("prior") * (1 - F.col("prior"))
    # A child without outcomes says nothing.
    excess = F.when(F.col("n") > 0, F.pow(F.col("bad") - F.col("n") * F.col("prior"), F.lit(2)) / F.col("n") - variance)
    weight = F.when(F.col("n") > 0, variance * (F.col("n") - 1))
    e, w = children.agg(F.sum(excess), F.sum(weight)).first()
    rho = max(LEAST_RHO, min(MOST_RHO, e / w if w else MOST_RHO))
    k = F.lit(1 / rho - 1)
    mean = (k * F.col("prior") + F.col("bad")) / (k + F.col("n"))
    share = k / (k + F.col("n"))
    own = F.col("mean") * (1 - F.col("mean")) / (k + F.col("n") + 1)
    return children.withColumn("mean", mean).select(key, "mean", (own + share * share * F.col("prior_doubt")).alias("doubt"))


def reputations(counts: DataFrame) -> DataFrame:
    """Per host posterior mean and ``bound``, its lower bound, of (host, n, bad) rows: outcomes and bad ones among them.

    Without any outcome all hosts have mean one half.
    """
    hosts = stored(counts.select(
        "host", _last_labels(F.col("host"), 2).alias("domain"), _last_labels(F.col("host"), 1).alias("suffix"), "n", "bad"
    ), "hosts")
    counted = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    domains = stored(hosts.groupBy("domain", "suffix").agg(*counted), "domains")
    suffixes = domains.groupBy("suffix").agg(*counted)
    n, bad = (x or 0 for x in suffixes.agg(F.sum("n"), F.sum("bad")).first())
    # All pages: a uniform prior.
    mean = (bad + 1) / (n + 2)
    whole = suffixes.withColumn("prior", F.lit(mean)).withColumn("prior_doubt", F.lit(mean * (1 - mean) / (n + 3)))
    prior = [F.col("mean").alias("prior"), F.col("doubt").alias("prior_doubt")]
    suffixes = stored(shrunk(whole, "suffix"), "suffixes")
    domains = domains.join(suffixes.select("suffix", *prior), "suffix")
    domains = stored(shrunk(domains, "domain"), "domain-scores")
    done = shrunk(hosts.join(domains.select("domain", *prior), "domain"), "host")
    return done.select("host", "mean", (F.col("mean") - Z * F.sqrt("doubt")).alias("bound"))


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): of each host the rules (size, rule, path, verdict) for it or a domain above it, longest first.

    A host is met with its last labels, as many as some rule's host has, so the work is linear in a host's length. A list
    holds no more than the rules that name the host or one of its parents.
    """
    def labels(host):
        return F.size(F.split(host, "\\."))

    # At most one number per label of the longest rule.
    sizes = [r[0] for r in rules.select(labels("host")).distinct().collect() if r[0] > 0]
    if not sizes:
        return hosts.select("host", F.lit(None).cast("array<struct<size:int,rule:string,path:string,verdict:string>>").alias("rules"))
    parents = F.array_distinct(F.array(*[F.substring_index("host", ".", -n) for n in sorted(sizes)]))
    wide = hosts.select("host", F.explode(parents).alias("rule_host"))
    found = F.struct((F.length("rule_host") + F.length("path")).alias("size"), F.concat("rule_host", "path").alias("rule"), "path", "verdict")
    named = rules.select(F.col("host").alias("rule_host"), "path", "verdict")
    return wide.join(named, "rule_host").groupBy("host").agg(F.sort_array(F.collect_set(found), asc=False).alias("rules"))


def judge(pages: DataFrame, labels: DataFrame, rules: DataFrame, page_col: str = "page_id", url_col: str = "url",
          label_col: str = "page_id", bad_rate: float = BAD_RATE) -> DataFrame:
    """One row per page: id, host, path, ``rule`` (host and path, else NULL), ``verdict`` and the host's ``bound``.

    ``labels`` has (label_col, bad) rows with bad 0 or 1: each is one outcome of each page row with that id. ``rules``
    has (host, path, verdict): the longest whose host is the page's or a domain above it and whose path begins the
    page's decides; else the host's reputation. NULL and malformed URLs have empty host and path, share the reputation
    of the empty host and fit no rule. NULL ids have no labels; repeated rows are judged each for itself; an empty
    table gives no rows; without labels all is allowed that no rule blocks; extra columns are ignored.
    """
    url = F.col(url_col)
    seen = pages.select(F.col(page_col).alias("page"), host_of(url).alias("host"), path_of(url).alias("path"))
    given = labels.where("bad IN (0, 1)").groupBy(F.col(label_col).alias("page")).agg(F.count("*").alias("of"), F.sum("bad").alias("bad"))
    # One host may have a third of the pages: they are counted before the shuffle.
    totals = [F.coalesce(F.sum(c), F.lit(0)).alias(name) for c, name in (("of", "n"), ("bad", "bad"))]
    scores = stored(reputations(seen.join(given, "page", "left").groupBy("host").agg(*totals)), "scores")
    hosts = scores.join(rules_by_host(scores.select("host"), rules), "host", "left").select("host", "bound", "rules")
    # Stored, so that both sides of the join below are plain and the pages of one host can be split.
    hosts = stored(hosts, "judged-hosts")
    fitting = F.filter("rules", lambda r: F.startswith(F.col("path"), r["path"]))
    judged = seen.join(hosts, "host").withColumn("fit", F.try_element_at(fitting, F.lit(1)))
    method = F.when(F.col("bound") > bad_rate, "block").otherwise("allow")
    return judged.select(
        F.col("page").alias(page_col), "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), method).alias("verdict"), "bound",
    )
