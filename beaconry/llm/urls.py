"""URL filters: fixed rules first, else the shrunken reputation of the host."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beaconry.llm.support import ascii_lower, staged

PARTS = r"://([^/?#]*)([^?#]*)"


@dataclass(frozen=True)
class Rule:
    """``verdict`` (allow or block) for a host with all its subdomains, and for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))


def matched_rule(rules: list[Rule], host: Column, path: Column) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null; of equally long ones a block, then the first by name."""
    ranked = sorted(rules, key=lambda r: (-len(r.name), r.verdict != "block", r.name))
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(ranked):
        hit = fits(rule, host, path)
        name, verdict = F.when(hit, F.lit(rule.name)).otherwise(name), F.when(hit, F.lit(rule.verdict)).otherwise(verdict)
    return name, verdict


def suffix_of(host: Column, suffixes: tuple[str, ...]) -> Column:
    """The longest of ``suffixes`` that the host ends in, else its last label."""
    out = F.substring_index(host, ".", -1)
    for s in sorted(suffixes, key=lambda s: (len(s), s)):
        out = F.when((host == s) | F.endswith(host, F.lit("." + s)), F.lit(s)).otherwise(out)
    return out


def registered_domain(host: Column, suffix: Column) -> Column:
    """The suffix and one label more; the host itself where it has no more."""
    head = F.substring(host, F.lit(1), F.length(host) - F.length(suffix) - 1)
    return F.when(F.length(host) > F.length(suffix), F.concat_ws(".", F.substring_index(head, ".", -1), suffix)).otherwise(host)


def concentration(groups: DataFrame, n: str, k: str) -> float:
    """The moment estimate of alpha + beta of a beta-binomial over the groups' rates, within [1, 10000].

    The groups' spread S = sum n (k/n - p)^2 is compared with what binomial noise alone would give.
    """
    sums = groups.filter(F.col(n) > 0).agg(
        F.sum(n).cast("double").alias("nn"), F.sum(k).cast("double").alias("kk"), F.count("*").cast("double").alias("g"),
        F.sum(F.col(k).cast("double") * F.col(k) / F.col(n)).alias("kkn"),
        F.sum(F.col(n).cast("double") * F.col(n)).alias("n2"))
    p = F.col("kk") / F.col("nn")
    noise = p * (1 - p)
    spread = F.col("kkn") - F.col("kk") * p
    freedom = F.col("nn") - F.col("n2") / F.col("nn") - (F.col("g") - 1)
    rho = F.try_divide(spread - noise * (F.col("g") - 1), noise * freedom)
    held = F.least(F.greatest(F.coalesce(rho, F.lit(0.0)), F.lit(1 / 10001)), F.lit(0.5))
    return sums.select((1 - held) / held).first()[0]


def host_reputation(outcomes: DataFrame, suffixes: tuple[str, ...], z: float) -> DataFrame:
    """(host, n, k, mean, upper) for every host of ``outcomes`` (host, outcomes, good: how many a page has, and how many of them
    are good; null where unlabelled).

    Rates shrink from the suffix to the registered domain to the host: each level's prior is a beta distribution around
    the mean of the level above, as strong as the spread between the groups of that level asks for. ``upper`` is the
    posterior mean of the host and ``z`` posterior standard deviations, at most 1; it is 1 where nothing is labelled at all.
    """
    s = suffix_of(F.col("host"), suffixes)
    hosts = (outcomes.groupBy("host").agg(F.coalesce(F.sum("outcomes"), F.lit(0)).alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("k"))
             .withColumn("suffix", s).withColumn("domain", registered_domain(F.col("host"), F.col("suffix"))))
    hosts = staged(hosts, "hosts")  # a row for each host, read by every level
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("k").alias("dk"))
    tops = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dk").alias("sk"))
    domains, tops = staged(domains, "domains"), staged(tops, "suffixes")
    whole = tops.agg(F.coalesce(F.sum("sk"), F.lit(0)).alias("k"), F.coalesce(F.sum("sn"), F.lit(0)).alias("n")).first()
    base = (whole.k + 1) / (whole.n + 2)
    c_suffix, c_domain, c_host = concentration(tops, "sn", "sk"), concentration(domains, "dn", "dk"), concentration(hosts, "n", "k")
    tops = tops.withColumn("s_mean", (F.col("sk") + c_suffix * base) / (F.col("sn") + c_suffix))
    domains = (domains.join(tops.select("suffix", "s_mean"), "suffix")
               .withColumn("d_mean", (F.col("dk") + c_domain * F.col("s_mean")) / (F.col("dn") + c_domain)))
    a = F.col("k") + c_host * F.col("d_mean")
    b = F.col("n") - F.col("k") + c_host * (1 - F.col("d_mean"))
    mean = F.col("a") / (F.col("a") + F.col("b"))
    sd = F.sqrt(F.col("a") * F.col("b") / ((F.col("a") + F.col("b")) * (F.col("a") + F.col("b")) * (F.col("a") + F.col("b") + 1)))
    return (hosts.join(domains.select("domain", "d_mean"), "domain")
            .withColumn("a", a).withColumn("b", b)
            .select("host", "n", "k", mean.alias("mean"), (F.least(F.lit(1.0), mean + z * sd) if whole.n else F.lit(1.0)).alias("upper")))


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], suffixes: tuple[str, ...] = (),
               floor: float = 0.8, z: float = 1.645) -> DataFrame:
    """Allow or block every url of ``pages`` (page_id, url).

    ``outcomes`` (page_id, good) says of labelled pages whether they were good (1) or not (0); several outcomes of one
    page all count. The longest rule that fits decides; where none does, a host is blocked when even the upper bound of
    its posterior rate of good pages stays below ``floor``. Returns page_id, host, path, rule, verdict, rate and upper
    for every row. A null url or one without ``://`` has empty host and path and is judged as the host '' is. Null page
    ids match no outcome; repeated rows are each judged, and each counts for its host. Hosts without outcomes take
    their domain's prior. The rule list is a parameter that the driver holds; it is turned into one expression.
    """
    rows = pages.select(F.col("page_id"), F.col("url").cast("string").alias("url"))
    rows = rows.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    marks = (outcomes.filter(F.col("good").isNotNull())
             .groupBy(F.col("page_id").alias("marked")).agg(F.count("*").alias("m"), F.sum(F.col("good").cast("long")).alias("g")))
    seen = (rows.select("page_id", "host").join(marks, F.col("page_id") == F.col("marked"), "left")
            .select("host", F.col("m").alias("outcomes"), F.col("g").alias("good")))
    rates = host_reputation(seen, suffixes, z).select(F.col("host").alias("rated"), F.col("mean").alias("rate"), "upper")
    name, said = matched_rule(rules, F.col("host"), F.col("path"))
    out = rows.join(rates, F.col("host") == F.col("rated"), "left")
    own = F.when(F.col("upper") < floor, "block").otherwise("allow")
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(said, own).alias("verdict"), "rate", "upper")
