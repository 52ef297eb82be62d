"""URL verdicts: host rules and empirical-Bayes host reputation, in DataFrame expressions only.

Reputation: labelled page outcomes (bad or not) are counted per host.  A host's bad rate has a beta prior
centred on its registered domain's rate, the domain's on its suffix's, the suffix's on the overall
rate; each level's prior strength comes from the spread between its members (moments of the
beta-binomial).  A host without outcomes has its parent's posterior.  The verdict blocks a url when the
lower bound (mean - z sd) of its host's posterior exceeds ``threshold``.

Rules are (action, host/path prefix).  A rule fits its host and all subdomains of it when the url's
path starts with the rule's path; the longest fitting rule decides before the reputation.

Everything is joined per distinct host: counting is a partial aggregate, and pages meet the host table
in one join that Spark broadcasts when it is small and splits on skew when it is not.

Defined results: a null url, or one without ``://``, has empty host and path, fits no rule and is judged by the
overall rate; repeated rows each get their row; without any outcome every rate is the prior's
(``PRIOR_RATE``); outcomes with a null verdict or id are ignored; several outcomes of a page all count.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerwise.llm.common import materialise, prepare

# FIXED VALUES: the query's rules
RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"), ("block", "com/de/")]
# public suffixes of more than one label that the registered domain respects
LONG_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br", "co.in", "co.za")
PRIOR_RATE = 0.5
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL_PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL_PARTS, 2), F.lit(""))


def _last_labels(host: Column, n: int) -> Column:
    return F.substring_index(host, ".", -n)


def suffix_of(host: Column) -> Column:
    return F.when(_last_labels(host, 2).isin(*LONG_SUFFIXES), _last_labels(host, 2)).otherwise(_last_labels(host, 1))


def domain_of(host: Column) -> Column:
    return F.when(_last_labels(host, 2).isin(*LONG_SUFFIXES), _last_labels(host, 3)).otherwise(_last_labels(host, 2))


def _strength(level: DataFrame) -> DataFrame:
    """One row ``s``: prior strength from the spread of (k, n, m) rows, m the centre each is shrunk to."""
    f = level.filter("n > 0").agg(
        F.count(F.lit(1)).alias("g"), F.sum("n").cast("double").alias("n"), F.sum(F.col("n") * F.pow(F.col("k") / F.col("n") - F.col("m"), 2)).alias("ss"),
        F.sum(F.col("n") * F.col("m") * (1 - F.col("m"))).alias("vv"))
    spread, binomial = F.col("ss") / F.col("n"), F.col("vv") / F.col("n")
    noise = binomial * F.col("g") / F.col("n")
    s = F.when(F.coalesce(F.col("g"), F.lit(0)) < 2, F.lit(MAX_STRENGTH)).when(spread <= noise, F.lit(MAX_STRENGTH)) \
        .otherwise((binomial - spread) / (spread - noise))
    return f.select(F.round(F.greatest(F.lit(MIN_STRENGTH), F.least(F.lit(MAX_STRENGTH), s)), 6).alias("s"))


def _shrunk(counts: DataFrame, parent: DataFrame, up: str) -> DataFrame:
    """counts(key, up, k, n) with the posterior (a, b) under parent(key as ``up``, m)."""
    level = counts.join(parent.select(F.col("key").alias(up), "m"), up)
    s = _strength(level).first()["s"]  # one number
    return level.select("key", up, (F.col("k") + F.col("m") * s).alias("a"), (F.col("n") - F.col("k") + (1 - F.col("m")) * s).alias("b")) \
        .withColumn("m", F.col("a") / (F.col("a") + F.col("b")))


def reputation(spark, hosts: DataFrame, z: float) -> DataFrame:
    """hosts(host, k, n): bad and all labelled pages per host -> (host, bound)."""
    named = hosts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "k", "n")
    domains = named.groupBy(F.col("domain").alias("key"), "suffix").agg(F.sum("k").alias("k"), F.sum("n").alias("n"))
    suffixes = domains.groupBy(F.col("suffix").alias("key")).agg(F.sum("k").alias("k"), F.sum("n").alias("n")).withColumn("top", F.lit(""))
    overall = suffixes.agg(F.lit("").alias("key"), F.coalesce(F.sum("k") / F.nullif(F.sum("n"), F.lit(0)), F.lit(PRIOR_RATE)).alias("m"))
    suffix_post = materialise(spark, _shrunk(suffixes, overall, "top"), "url-suffixes", small=True)
    domain_post = materialise(spark, _shrunk(domains, suffix_post, "suffix"), "url-domains", small=True)
    host_post = _shrunk(named.select(F.col("host").alias("key"), "domain", "k", "n"), domain_post, "domain")
    a, b = F.col("a"), F.col("b")
    sd = F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))
    return host_post.select(F.col("key").alias("host"), F.round(F.col("m") - z * sd, 6).alias("bound"))


def _host_rules(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules of the host and of the domains above it; hosts(host)."""
    labels = F.split("host", r"\.")
    tails = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    cut = rules.select("action", "rule", F.substring_index("rule", "/", 1).alias("tail"),
                       F.expr("substring(rule, length(substring_index(rule, '/', 1)) + 1)").alias("prefix"))
    return hosts.select("host", F.explode(tails).alias("tail")).join(cut, "tail") \
        .groupBy("host").agg(F.collect_set(F.struct(F.length("rule").alias("size"), "rule", "prefix", "action")).alias("rules"))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: DataFrame | None = None, z: float = 1.645, threshold: float = 0.35) -> DataFrame:
    """(page_id, host, path, rule, verdict, bound) of every row of pages(page_id, url).

    outcomes(url, bad): labelled pages.  rules(action, rule), by default ``RULES``."""
    spark = pages.sparkSession
    prepare(spark)
    if rules is None:
        rules = spark.createDataFrame(RULES, "action string, rule string")
    parts = pages.select(F.col("page_id").alias("page_id"), host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    counted = outcomes.filter("bad is not null").select(host_of(F.col("url")).alias("host"), F.col("bad").cast("boolean").alias("bad")) \
        .groupBy("host").agg(F.count_if("bad").alias("k"), F.count(F.lit(1)).alias("n"))
    hosts = parts.select("host").distinct()
    counted = hosts.join(counted, "host", "full").select("host", F.coalesce("k", F.lit(0)).alias("k"), F.coalesce("n", F.lit(0)).alias("n"))
    counted = materialise(spark, counted, "url-hosts", small=True)
    known = reputation(spark, counted, z).join(_host_rules(counted.select("host"), rules), "host", "left")
    known = materialise(spark, known, "url-known", small=True)
    joined = parts.join(known, "host", "left")
    fitting = F.filter("rules", lambda r: F.col("path").startswith(r["prefix"]))
    best = F.array_max(fitting)
    verdict = F.coalesce(best["action"], F.when(F.col("bound") > threshold, "block").otherwise("allow"))
    return joined.select("page_id", "host", "path", best["rule"].alias("rule"), verdict.alias("verdict"), "bound")
