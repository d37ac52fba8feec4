"""URL filter with host reputation by empirical Bayes.

Labelled page outcomes are counted per host and shrunk: the prior of a host is
a beta distribution around the posterior mean of its registered domain, that of
a domain lies around its suffix, that of a suffix around the overall rate. The
strength of the prior at each level is estimated from the data by the moments
of the beta-binomial distribution. A host is blocked when even the upper
posterior bound of its good rate is below ``min_good``. Fixed rules come first.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyhawk.llm.common import saved

#: (verdict, host, path)
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
#: suffixes of two labels under which names are registered
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "co.jp", "co.in", "co.nz")
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column | str) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty without ``://``."""
    return F.translate(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1),
                       "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column | str) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column | str) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest rule that fits, else nulls. A rule
    fits its host and all subdomains if the path starts with the rule's.
    ``rules`` is configuration, so it becomes one expression."""
    rule, verdict = F, F
    for what, h, p in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = rule.when(fits, F.lit(h + p)), verdict.when(fits, F.lit(what))
    return (rule, verdict) if rules else (F.lit(None).cast("string"),) * 2


def suffix_of(host: Column) -> Column:
    two = F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1)
    return F.when(two.isin(*LONG_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and one label more; a host of one label is its own domain."""
    two = F.regexp_extract(host, r"([^.]*\.[^.]*)$", 1)
    return F.when(two.isin(*LONG_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(
        F.substring_index(host, ".", -2))


def reputation(outcomes: DataFrame, z: float = 1.645) -> DataFrame:
    """Posterior of each host.

    ``outcomes``: ``host`` and ``good`` (1, 0, or null where a page has no
    label). Returns host, domain, suffix, n, good, mean, lower, upper (bounds
    at ``z`` posterior standard deviations). Hosts without labels rest on
    their domain. Rows are summed per host before anything else is shuffled,
    so a hot host is no hot task; the levels above have at most a row per host.
    """
    hosts = (outcomes.groupBy("host").agg(F.count("good").alias("n"),
                                          F.coalesce(F.sum(F.col("good").cast("long")), F.lit(0)).alias("good"))
             .withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host"))))
    hosts = saved(hosts, "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    level = suffixes.crossJoin(suffixes.agg(  # one row
        ((F.coalesce(F.sum("good"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("prior")))
    suffixes = _shrink(level)
    level = domains.join(suffixes.select("suffix", F.col("mean").alias("prior")), "suffix")
    domains = _shrink(level)
    hosts = _shrink(hosts.join(domains.select("domain", "suffix", F.col("mean").alias("prior")), ["domain", "suffix"]))
    sd = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("strength") + 1))
    return hosts.select("host", "domain", "suffix", "n", "good", "mean",
                        F.greatest(F.lit(0.0), F.col("mean") - z * sd).alias("lower"),
                        F.least(F.lit(1.0), F.col("mean") + z * sd).alias("upper"))


def _shrink(level: DataFrame) -> DataFrame:
    """Posterior means of the rows of one level (n, good, prior). With rho the
    correlation inside a group, the squared deviations n * (rate - prior)^2
    are expected at prior * (1 - prior) * (1 + (n - 1) * rho); the strength of
    the prior is 1 / rho - 1, with rho held between 0.001 and 0.999."""
    var = F.col("prior") * (1 - F.col("prior"))
    dev = F.col("good") - F.col("n") * F.col("prior")
    some = F.col("n") > 0
    moments = level.agg(
        F.sum(F.when(some, dev * dev / F.col("n") - var)).alias("over"),
        F.sum(F.when(some, var * (F.col("n") - 1))).alias("scale"))
    rho = F.when(F.col("scale") > 0, F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.col("over") / F.col("scale"))))
    strength = moments.select((1 / F.coalesce(rho, F.lit(0.5)) - 1).alias("strength"))  # one row
    return level.crossJoin(F.broadcast(strength)).withColumn(
        "mean", (F.col("good") + F.col("strength") * F.col("prior")) / (F.col("n") + F.col("strength")))


def filter_urls(pages: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
                min_good: float = 0.85, z: float = 1.645, url_col: str = "url", id_col: str = "page_id",
                label_id: str = "page_id", label_col: str = "good") -> DataFrame:
    """Verdict of every row of ``pages``: page_id, host, path, rule, verdict,
    good_rate, upper.

    ``labels``: outcomes of some pages (``label_id``, ``label_col`` 1 or 0); a
    page labelled more than once counts by its smallest label, null ids and
    labels count nowhere. Null urls and urls without ``://`` share the empty
    host. Repeated pages are judged alike; no pages give no rows. Columns of
    ``pages`` other than the two named are not read.
    """
    seen = (labels.where(F.col(label_id).isNotNull() & F.col(label_col).isNotNull())
            .groupBy(F.col(label_id).alias("page_id")).agg(F.min(label_col).alias("good")))
    read = pages.select(F.col(id_col).alias("page_id"), host_of(url_col).alias("host"), path_of(url_col).alias("path"))
    known = reputation(read.join(seen, "page_id", "left"), z).select("host", F.col("mean").alias("good_rate"), "upper")
    rule, verdict = rule_for(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("upper") < min_good, F.lit("block")).otherwise(F.lit("allow"))
    return read.join(known, "host").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, by_host).alias("verdict"),
        "good_rate", "upper")
