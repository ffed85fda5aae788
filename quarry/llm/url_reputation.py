"""URL filters: empirical-Bayes host reputation.

Labelled page outcomes are summed per host, registered domain and suffix. Each level is a beta-binomial
whose prior mean is the posterior mean of the level above and whose prior strength is estimated from the
spread of the level's own groups (method of moments), so a host with few labels takes its domain's rate
and a domain with few labels its suffix's. A page is blocked if the lower bound of its host's posterior
bad rate is above a limit. Only sums per host are ever joined; hot hosts are summed on the map side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import join_hot
from quarry.session import cut_lineage

#: (rule, verdict): a host suffix, a slash and a path prefix.
RULES = (("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow"))
#: Public suffixes of two labels that are looked up; every other suffix is taken as one label.
MULTI_SUFFIXES = tuple(f"{second}.{top}" for top, seconds in (
    ("uk", "ac co gov ltd me net org plc sch"), ("au", "asn com edu gov id net org"), ("nz", "ac co govt net org school"),
    ("jp", "ac ad co ed go gr lg ne or"), ("kr", "ac co go ne or re"), ("in", "ac co edu firm gen gov ind net org res"),
    ("br", "com edu gov net org"), ("ar", "com edu gob net org"), ("mx", "com edu gob net org"), ("co", "com edu gov net org"),
    ("pe", "com edu gob net org"), ("cn", "ac com edu gov net org"), ("hk", "com edu gov net org"), ("tw", "com edu gov net org"),
    ("sg", "com edu gov net org"), ("my", "com edu gov net org"), ("ph", "com edu gov net org"), ("th", "ac co go in or"),
    ("id", "ac co go or web"), ("vn", "com edu gov net org"), ("tr", "com edu gov net org"), ("il", "ac co gov net org"),
    ("za", "ac co gov net org"), ("ng", "com edu gov net org"), ("eg", "com edu gov net org"), ("sa", "com edu gov net org"),
    ("pk", "com edu gov net org"), ("ua", "com edu gov net org"), ("pl", "com edu gov net org"), ("es", "com edu gob nom org"),
) for second in seconds.split())
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def split_url(pages: DataFrame, url_col: str = "url") -> DataFrame:
    """Add ``host`` (after the first ://, A-Z lower-cased) and ``path`` (then up to ? or #); a null url
    or one without :// has both empty. Both are recomputed if the table has columns of these names."""
    url = F.col(url_col)
    rest = F.regexp_extract(url, "(?s)^.*?://(.*)$", 1)
    host = F.translate(F.regexp_extract(rest, "(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, "(?s)^[^/?#]*([^?#]*)", 1)
    return pages.withColumn("host", F.coalesce(host, F.lit(""))).withColumn("path", F.coalesce(path, F.lit("")))


def match_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls. Rules of one length: the first listed."""
    rule = verdict = F.lit(None).cast("string")
    for text, said in sorted(rules, key=lambda r: len(r[0])):
        name, _, rest = text.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit("/" + rest))
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _name(host: Column) -> Column:
    """The host without its port."""
    return F.regexp_replace(host, ":[0-9]*$", "")


def _is_address(host: Column) -> Column:
    return F.startswith(host, F.lit("[")) | _name(host).rlike("^[0-9]{1,3}(\\.[0-9]{1,3}){3}$")


def registered_domain(host: Column) -> Column:
    """The public suffix of a host and one label more, without the port; an IP address is its own domain."""
    name = _name(host)
    two = F.substring_index(name, ".", -2)
    return F.when(_is_address(host), name).when(two.isin(*MULTI_SUFFIXES), F.substring_index(name, ".", -3)).otherwise(two)


def suffix(host: Column) -> Column:
    """The public suffix of a host: one of MULTI_SUFFIXES or the last label; IP addresses share one of their own."""
    two = F.substring_index(_name(host), ".", -2)
    return F.when(_is_address(host), F.lit("[ip]")).when(two.isin(*MULTI_SUFFIXES), two).otherwise(F.substring_index(two, ".", -1))


def _strength(groups: DataFrame, prior: Column) -> DataFrame:
    """One row: prior strength of a level, by the method of moments. With p the prior mean of a group of
    n labels and x bad ones, E[(x-np)^2] = np(1-p)(1 + (n-1) rho); strength = 1/rho - 1, rho kept in
    [0.001, 0.5] so that a level without spread still shrinks and a wild one still learns."""
    pq, n = prior * (1 - prior), F.col("n")
    excess = F.sum(F.pow(F.col("bad") - n * prior, 2) - n * pq)
    scale = F.sum(n * (n - 1) * pq)
    rho = F.when(scale > 0, F.least(F.lit(0.5), F.greatest(F.lit(0.001), excess / scale))).otherwise(F.lit(0.5))
    return groups.agg((1 / F.coalesce(rho, F.lit(0.5)) - 1).alias("strength"))


def host_reputation(outcomes: DataFrame, salts: int = 16) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Posteriors (alpha, beta of the bad rate) per level from ``outcomes`` (host, bad 0/1; null bad is
    unlabelled and ignored): frames (all, suffix, domain, host). With no labels at all the overall rate
    is one half with one pseudo-label."""
    hosts = (
        outcomes.where(F.col("bad").isNotNull())
        .groupBy("host").agg(F.count("*").alias("n"), F.sum(F.col("bad").cast("double")).alias("bad"))
        .withColumn("domain", registered_domain(F.col("host"))).withColumn("suffix", suffix(F.col("host")))
    )
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    overall = suffixes.agg(((F.coalesce(F.sum("bad"), F.lit(0.0)) + 0.5) / (F.coalesce(F.sum("n"), F.lit(0)) + 1)).alias("mean"))

    def posterior(groups, key, prior):
        g = groups.withColumn("strength", _strength(groups, prior).scalar())
        a, b = F.col("strength") * prior + F.col("bad"), F.col("strength") * (1 - prior) + F.col("n") - F.col("bad")
        return g.select(key, a.alias("alpha"), b.alias("beta"), (a / (a + b)).alias("mean"))

    post_s = posterior(suffixes.withColumn("up", overall.scalar()), "suffix", F.col("up"))
    d = domains.join(post_s.select("suffix", F.col("mean").alias("up")), "suffix")
    post_d = posterior(d, "domain", F.col("up"))
    # One domain may own most hosts: its row is repeated once per salt, its hosts are dealt over the salts.
    up = post_d.select("domain", F.col("mean").alias("up"), F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    h = hosts.withColumn("salt", F.pmod(F.xxhash64("host"), F.lit(salts)).cast("int")).join(up, ["domain", "salt"])
    return overall, post_s, post_d, posterior(h, "host", F.col("up"))


def judge_pages(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES, limit: float = 0.5,
                z: float = 1.645, page_col: str = "page_id", url_col: str = "url", salts: int = 16) -> DataFrame:
    """One row per row of ``pages``: page_col, host, path, rule, verdict, bad_rate, bad_low.

    ``outcomes``: (page_col, bad 0/1) for some pages; pages with repeated outcomes count each of them.
    bad_rate is the posterior mean of the page's host, or of its domain, its suffix or all pages where
    the narrower level has no label; bad_low is that posterior's lower bound (mean - z standard
    deviations, at least 0). A rule decides where one fits; else a page is blocked if bad_low > limit.
    Null urls have an empty host and are judged by the overall rate. Empty tables give empty results.
    """
    judged = split_url(pages.select(F.col(page_col).alias("page_id"), F.col(url_col).alias("url"))).drop("url")
    labels = outcomes.select(F.col(page_col).alias("page_id"), "bad")
    overall, post_s, post_d, post_h = host_reputation(judged.join(labels, "page_id").select("host", "bad"), salts)
    # All distinct hosts, labelled or not, get their answer once; pages then need a single join, in which hosts
    # with very many pages are broadcast.
    hosts = judged.groupBy("host").agg(F.count("*").alias("pages")).select(
        "host", "pages", registered_domain(F.col("host")).alias("domain"), suffix(F.col("host")).alias("suffix"))
    pick = lambda p, k: p.select(k, F.struct("alpha", "beta").alias(f"of_{k}"))
    salt = F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
    answer = (
        hosts.withColumn("salt", F.pmod(F.xxhash64("host"), F.lit(salts)).cast("int"))
        .join(pick(post_d, "domain").select("*", salt), ["domain", "salt"], "left")
        .join(pick(post_s, "suffix").select("*", salt), ["suffix", "salt"], "left")
        .join(pick(post_h, "host"), "host", "left")
        .withColumn("of_all", overall.select(F.struct(F.col("mean").alias("alpha"), (1 - F.col("mean")).alias("beta"))).scalar())
        .withColumn("p", F.coalesce("of_host", "of_domain", "of_suffix", "of_all"))
    )
    a, b = F.col("p.alpha"), F.col("p.beta")
    mean = a / (a + b)
    sd = F.sqrt(a * b / (F.pow(a + b, 2) * (a + b + 1)))
    answer = answer.select("host", "pages", mean.alias("bad_rate"), F.greatest(F.lit(0.0), mean - z * sd).alias("bad_low"))
    rule, said = match_rule(F.col("host"), F.col("path"), rules)
    return join_hot(judged, cut_lineage(answer), ["host"], "pages").select(
        F.col("page_id").alias(page_col), "host", "path", rule.alias("rule"),
        F.coalesce(said, F.when(F.col("bad_low") > limit, F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        "bad_rate", "bad_low")
